"""Sequence packing as vector bin packing with the dot-product heuristic.

Every example has three demands: tokens, one segment, and loss-bearing tokens
(those after its prompt). A sequence has a limit on each. The next piece of a
sequence is the example that fits whole and whose demand has the largest dot
product with the sequence's remaining room (both in shares of the limits); when
none fits, the longest example is cut to fill what is left. Tasks pack their own
rows, batch by batch, carrying the open sequence along, so nothing is shuffled
and memory is bounded by a batch. A sequence that another limit ends before its
tokens are full, and what is left at a task's end, is cut into sequences whose
lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .bpe import byte_alphabet

MAX_TOKENS = 2048
MAX_SEGMENTS = 256
MAX_LOSS_TOKENS = 2048
END_ID = 1
_ROWS, _BYTES = 2000, 8 << 20  # rows and text bytes packed at a time
_CACHE = 300_000  # words a generation of a worker's token cache holds


class Packer:
    """Packs examples ``(key, tokens, prompt)``; yields sequences as lists of ``(key, start, length)``."""

    def __init__(self, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS_TOKENS):
        self.limits = (max_tokens, max_segments, max_loss)
        if min(self.limits) < 1:
            raise ValueError("limits must be positive")
        self.open: list[tuple] = []  # (key, start, length, prompt left) of the unfinished sequence

    def add(self, examples: list[tuple]):
        """Pack a batch of ``(key, tokens, prompt)``; the last sequence stays open for the next batch."""
        items = self.open + [(k, 0, n, min(p, n)) for k, n, p in examples if n > 0]
        self.open = []
        done = list(self._pack(items))
        if done:
            *full, last = done
            if sum(x[2] for x in last) == self.limits[0]:
                full.append(last)
            else:
                self.open = last
            for s in full:
                yield from [[x[:3] for x in s]] if sum(x[2] for x in s) == self.limits[0] else self._powers(s)

    def finish(self):
        """The open sequence, cut into sequences whose lengths are powers of two."""
        yield from self._powers(self.open)
        self.open = []

    def _powers(self, pieces: list[tuple]):
        room, cut = 0, []
        left = sum(x[2] for x in pieces)
        for key, start, n, _ in pieces:
            while n:
                if not room:
                    room = 1 << (left.bit_length() - 1)
                take = min(n, room)
                cut.append((key, start, take))
                start, n, room, left = start + take, n - take, room - take, left - take
                if not room:
                    yield cut
                    cut = []

    def _pack(self, items: list[tuple]):
        cap, segments, cap_loss = self.limits
        start = np.array([x[1] for x in items], dtype=np.int64)
        size = np.array([x[2] for x in items], dtype=np.int64)
        prompt = np.array([x[3] for x in items], dtype=np.int64)

        def cut(i: int, n: int) -> tuple:
            piece = (items[i][0], int(start[i]), n, int(min(prompt[i], n)))
            start[i], size[i], prompt[i] = start[i] + n, size[i] - n, max(0, prompt[i] - n)
            return piece

        # what exceeds a sequence by itself is cut off in whole sequences
        for i in np.flatnonzero((size > cap) | (size - prompt > cap_loss)).tolist():
            while size[i] > cap or size[i] - prompt[i] > cap_loss:
                yield [cut(i, int(min(cap, size[i], prompt[i] + cap_loss)))]
        live = np.flatnonzero(size)
        while len(live):
            tokens, room, loss, bin_ = cap, segments, cap_loss, []
            while tokens and room and loss and len(live):
                need, bears = size[live], size[live] - prompt[live]
                fits = (need <= tokens) & (bears <= loss)
                if fits.any():
                    gain = need * (tokens / cap ** 2) + bears * (loss / cap_loss ** 2)
                    at = int(np.argmax(np.where(fits, gain, -1.0)))
                    n = int(need[at])
                else:
                    at = int(np.argmax(need))
                    n = int(min(need[at], tokens, prompt[live[at]] + loss))
                piece = cut(live[at], n)
                bin_.append(piece)
                tokens, room, loss = tokens - n, room - 1, loss - (n - piece[3])
                if not size[live[at]]:
                    live = np.delete(live, at)
            yield bin_


class _Ids(dict):
    """Word -> its ids as bytes; computed when first asked for, and kept in two bounded generations."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.old = tokenizer, tokenizer.model, {}
        # Runs of these letters are one pre-token, of which no step before the model changes more than the case,
        # and signs behind them are the next one; the vocabulary itself says whether that is so.
        self.byte = {bytes([b]): c for b, c in enumerate(byte_alphabet())}
        alone = lambda c: len(c.lower()) == 1 and self._by_model(c) == self._whole(c)
        joined = self._by_model("internationalisation") == self._whole("internationalisation") and self._by_model("qzxjk") == self._whole("qzxjk")
        letters = [c for c in map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x250)]) if joined and c.isalpha() and alone(c)]
        signs = [c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c not in "'<" and self._whole("ab" + c) == self._whole("ab") + self._whole(c)]
        group = lambda some: "[" + re.escape("".join(some)) + "]" if some else "(?!)"
        self.plain = re.compile(f"({group(letters)}+)({group(signs)}*)")

    def _whole(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _by_model(self, letters: str) -> bytes:
        low = letters.lower()
        if not low.isascii():
            low = "".join([self.byte[low_byte.to_bytes()] for low_byte in low.encode()])
        return array("I", [t.id for t in self.model.tokenize(low)]).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        got = self.old.get(word)
        if got is None:
            text = word.decode()
            plain = self.plain.fullmatch(text)
            if not plain:
                got = self._whole(text)
            elif plain[2]:
                got = self[plain[1].encode()] + self._signs(plain[2])
            else:
                got = self._by_model(text)
        self[word] = got
        return got

    def _signs(self, signs: str) -> bytes:
        key = signs.encode()
        found = self.get(key) or self.old.get(key)
        if found is None:
            found = self[key] = self._whole(signs)
        return found

    def age(self) -> None:
        if len(self) > _CACHE:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Token ids of whole texts from the ids of their words.

    For vocabularies that lower-case and drop white space, whose pre-tokens
    therefore never span it, a text's ids are those of its words in turn.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ids = _Ids(self.tokenizer)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as bytes of little-endian unsigned 32-bit numbers."""
        self.ids.age()
        out = []
        for text in texts:
            raw = (text or "").encode()
            if b"<|" in raw:  # a special token's string counts in its own spelling only
                parts = raw.split()
            elif raw.isascii() or not (b"\xcc" in raw or b"\xcd" in raw):  # no combining mark (U+0300 to U+036F) in UTF-8
                parts = raw.lower().split()
            else:  # letters and marks compose before the vocabulary lower-cases, and not all capitals do as small letters do
                parts = [w.lower() if w.isascii() else w for w in raw.split()]
            out.append(b"".join(map(self.ids.__getitem__, parts)))
        return out


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _packing(path: str, end_id: int, limits: tuple[int, int, int], with_ids: bool):
    names = ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    types = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids

    def run(batches):
        packer, encoder, end = Packer(*limits), _encoder(path), array("I", [end_id]).tobytes()
        sequence = TaskContext.get().partitionId() << 40
        held: dict[int, tuple] = {}  # key -> (document, ids) of this batch and of what is open
        key = 0

        def rows(sequences):
            nonlocal sequence
            out = []
            for s in sequences:
                offset = 0
                for k, start, n in s:
                    doc, ids = held[k]
                    cut = ids[start:start + n]
                    out.append((doc, start, n, zlib.crc32(cut.tobytes()), len(ids), sequence, offset) + ((cut,) if with_ids else ()))
                    offset += n
                sequence += 1
            cols = list(zip(*out)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names)

        for batch in batches:
            for part in words.slices(batch, 1, _ROWS, _BYTES):
                examples = []
                prompts = part.column(2).to_pylist() if part.num_columns > 2 else [0] * part.num_rows
                for doc, ids, prompt in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), prompts):
                    held[key] = (doc, np.frombuffer(ids + end, dtype="<u4"))
                    examples.append((key, len(ids) // 4 + 1, prompt))
                    key += 1
                yield rows(packer.add(examples))
                live = {x[0] for x in packer.open}
                held = {k: v for k, v in held.items() if k in live}
        yield rows(packer.finish())

    return run


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                   max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS_TOKENS,
                   with_ids: bool = False, prompt_col: str | None = None) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    ``tokenizer`` is the path of a vocabulary file of the ``tokenizers`` library
    that every worker can read. A document is its ids and then ``end_id`` (a
    null or empty text: just that). ``prompt_col`` has the number of its first
    tokens that bear no loss (null or negative: none); without it all bear loss.
    Repeated rows are packed each for itself; a null id stays null. Other columns
    are ignored.
    """
    prompt = [] if prompt_col is None else [F.greatest(F.coalesce(F.col(prompt_col).cast("long"), F.lit(0)), F.lit(0)).alias("_p")]
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_t"), *prompt)
    schema = "_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids array<int>" * with_ids
    run = _packing(tokenizer, end_id, (max_tokens, max_segments, max_loss), with_ids)
    return src.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
