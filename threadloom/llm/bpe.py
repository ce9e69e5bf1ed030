"""Byte-level BPE: encoding by a priority queue over a linked symbol list, decoding by concatenation.

A vocabulary file of the ``tokenizers`` library gives symbols, merge ranks and
special tokens. Every pre-token starts as a doubly linked list of its bytes'
symbols; a heap holds ``(merge rank, place)`` of each neighbouring pair. The
lowest one is merged where it stands, its two new pairs are pushed, and entries
whose pair has meanwhile changed are skipped when they come up. Decoding
concatenates the vocabulary's strings, read back as bytes.

Pre-tokens never start inside a run of non-space characters, so a text is
encoded space-led piece by piece, and a worker keeps the ids of pieces it has
seen in a bounded cache. Tasks work batch by batch; nothing is shuffled.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words

_ROWS, _BYTES = 1000, 3 << 20  # rows and bytes of texts or ids worked on at a time
_CACHE, _LONGEST = 600_000, 64  # pieces a generation of a worker's cache holds, characters of the longest one kept

# Unicode white space, as the byte-level pre-token pattern takes it.
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b if b in prints else next(others)) for b in range(256)]


def merged(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """``symbols`` after all merges, lowest rank first and then leftmost.

    ``merges`` maps a pair of symbols to its ``(rank, new symbol)``.
    """
    n, found = len(symbols), merges.get
    symbols = list(symbols)
    heap = [(merge, i) for i, merge in enumerate(map(found, zip(symbols, symbols[1:]))) if merge]
    if not heap:
        return symbols
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heapq.heapify(heap)
    while heap:
        merge, i = heapq.heappop(heap)
        j = after[i]
        if j >= n or found((symbols[i], symbols[j])) != merge:
            continue  # stale: one of the two was merged since
        new = symbols[i] = merge[1]
        symbols[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if right := found((new, symbols[k])):
                heapq.heappush(heap, (right, i))
        h = before[i]
        if h >= 0 and (left := found((symbols[h], new))):
            heapq.heappush(heap, (left, h))
    return [s for s in symbols if s >= 0]


class Vocabulary:
    """Symbols, merges and special tokens of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if (model.get("type") != "BPE" or odd or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        ids = model["vocab"]
        self.pre_tokens = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.space = byte_alphabet()[0x20]
        self.symbol = {c: ids[c] for c in byte_alphabet() if c in ids}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        # letters that are one pre-token together with those before them, and signs that end them, as the vocabulary has it
        join = lambda c: len(self.pre_tokens("a" + c)) == 1
        letters = [c for c in map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250)]) if join(c)]
        signs = [c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'" and not join(c)]
        self.plain = re.compile(f"( ?[{''.join(letters)}]+)([{re.escape(''.join(signs))}]*)")
        self.first = [ids.get(c, -1) for c in byte_alphabet()]
        # the bytes each id stands for, one after the other
        byte = {c: i for i, c in enumerate(byte_alphabet())}
        strings = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in [*ids.items(), *self.special.items()]:
            plain = all(c in byte for c in token)
            strings[i] = bytes(byte[c] for c in token) if plain else token.encode()
        self.pool = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.length = np.array([len(x) for x in strings], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.new, self.old = {}, {}

    def _piece(self, piece: str) -> bytes:
        got = self.old.get(piece)
        if got is None:
            plain = self.plain.fullmatch(piece)
            if plain is None:
                out = array("i")
                for token, _ in self.pre_tokens(piece):
                    out.extend(merged([self.symbol[c] for c in token], self.merges))
                got = out.tobytes()
            elif plain[2]:
                got = self._known(plain[1]) + self._known(plain[2])
            else:
                got = array("i", merged([self.first[b] for b in piece.encode()], self.merges)).tobytes()
        if len(piece) <= _LONGEST:
            if len(self.new) >= _CACHE:
                self.old, self.new = self.new, {}
            self.new[piece] = got
        return got

    def _known(self, piece: str) -> bytes:
        return self.new.get(piece) or self._piece(piece)

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as native 32-bit numbers; special tokens' own strings become their ids."""
        out, at = [], 0
        cuts = [(m.start(), m.end()) for m in self.specials.finditer(text)] if self.specials else []
        for start, end in [*cuts, (len(text), None)]:
            known = self.new
            out += [known.get(p) or self._piece(p) for p in PIECE.findall(text, at, start)]
            if end is not None:
                out.append(array("i", [self.special[text[start:end]]]).tobytes())
                at = end
        return b"".join(out)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The texts of lists of ids: ``counts`` ids each, all in ``ids``, one list after the other.

        Ids outside the vocabulary have no text, broken UTF-8 becomes U+FFFD.
        """
        known = (ids >= 0) & (ids < len(self.length))
        ids = np.where(known, ids, 0)
        size = np.where(known, self.length[ids], 0)
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        data = self.pool[np.repeat(self.start[ids] - (end - size), size) + np.arange(total)]
        at = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(counts)])]
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        try:
            return raw.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())


_vocabularies: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _encoding(path: str, column: int, schema: pa.Schema):
    def run(batches):
        vocabulary = _vocabulary(path)
        for batch in batches:
            for part in words.slices(batch, column, _ROWS, _BYTES):
                codes = [vocabulary.encode(t or "") for t in part.column(column).to_pylist()]
                at = np.concatenate([[0], np.cumsum([len(c) // 4 for c in codes], dtype=np.int64)])
                ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(codes), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=schema)

    return run


def _decoding(path: str, column: int, names: list[str]):
    def run(batches):
        vocabulary = _vocabulary(path)
        for batch in batches:
            n = np.asarray(pc.fill_null(pc.list_value_length(batch.column(column)), 0), dtype=np.int64)
            total, at = np.cumsum(n), 0
            while at < batch.num_rows:
                before = total[at - 1] if at else 0
                end = min(at + _ROWS, max(at + 1, int(np.searchsorted(total, before + _BYTES // 4, side="right"))))
                part = batch.slice(at, end - at)
                ids = np.asarray(pc.fill_null(part.column(column).flatten(), -1))  # without what lies under null lists
                yield pa.RecordBatch.from_arrays([*part.columns, vocabulary.decode(ids, n[at:end])], names)
                at = end

    return run


def _added(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*[f for f in df.schema.fields if f.name != name], T.StructField(name, kind)])


def encode_documents(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text_col`` in ``ids_col`` (array of int).

    ``tokenizer`` is the path of a byte-level BPE vocabulary file of the
    ``tokenizers`` library that every worker can read; other kinds are refused.
    A null or empty text has no ids. Every row and column passes through, but an
    input column named ``ids_col`` gives way.
    """
    src = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != ids_col]).withColumn(text_col, F.col(text_col).cast("string"))
    schema = _added(src, ids_col, T.ArrayType(T.IntegerType()))
    return src.mapInArrow(_encoding(tokenizer, src.columns.index(text_col), schema.names), schema)


def decode_documents(docs: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids_col`` in ``out_col``: the vocabulary's strings one after the other.

    Special tokens keep their strings; null ids and ids that the vocabulary does
    not have are skipped; a null list gives an empty text. Every row and column
    passes through, but an input column named ``out_col`` gives way.
    """
    src = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out_col])
    schema = _added(src, out_col, T.StringType())
    return src.mapInArrow(_decoding(tokenizer, src.columns.index(ids_col), schema.names), schema)
