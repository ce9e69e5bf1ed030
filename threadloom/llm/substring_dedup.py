"""Substring deduplication by super-k-mer partitioning.

A window is ``k`` consecutive words of one document. Its minimiser is the
smallest hash among the ``m``-word runs inside it; consecutive windows that
share one travel as one packed string (a super-k-mer) to the minimiser's
bucket, so equal windows always meet there. A bucket sorts its windows by a
rolling hash of their bytes, checks equal neighbours byte by byte, and finds the
smallest and largest document of each. What a document loses goes back to it.

Skew: a batch sends each distinct string once however many documents repeat it,
with its occurrences while they are few. Strings that a batch repeats more often
leave their occurrences at home; those that turn out to hold a repeated window
are looked up in a second pass over the documents and joined by string hash, hot
ones by broadcast. Runs of words that are common in a bounded sample of documents
are chosen as minimisers only where a window has no other (this steers balance,
never results). Buckets are sized by the input's bytes and measured before anything
is sent: the windows of a bucket that would get more than SPLIT_BYTES go by longer
minimisers instead, and where those crowd too, each by the hash of all its words.
Which bucket a window goes to depends on its words alone, so equal windows still meet.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import bit_words, release, skew_join_once, stage

WINDOW = 13
MINIMISER_WORDS = 2
BUCKET_BYTES = 1 << 20  # text bytes whose super-k-mers share a bucket
SPLIT_BYTES = 8 << 20  # bytes of packed strings beyond which a bucket's windows are dealt anew
LISTED = 8  # occurrences of a string that a batch sends along
BITMAP_WORDS = 1 << 15  # 64-bit words of the second pass's bitmap of strings: 256 kB
SAMPLE_DOCS = 4000  # documents looked at for common word runs
COMMON_SHARE = 0.01  # of them, in this share or more: common
COMMON_MAX = 1024
_ROWS, _BYTES = 1500, 4 << 20  # documents and text bytes handed to numpy at a time
_LOADS = 1 << 20  # buckets whose load a measuring task holds
_NONE = np.iinfo(np.int64).max


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _run_hashes(h: np.ndarray, m: int) -> np.ndarray:
    """Hash of the m words from each position on (len - m + 1 of them)."""
    n = len(h) - m + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(m):
        out = _mix(out * np.uint64(3) + h[i:i + n])
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


_TABLE = np.random.default_rng(13).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(0, n - 1), base, dtype=np.uint64))])[:n]


class SuperKmers:
    """The super-k-mers of a batch of texts: text number, start word and bucket of each; strings on demand."""

    def __init__(self, texts: pa.Array, k: int, m: int, common: np.ndarray, buckets: int = 1, hot: tuple = ()):
        self.text = self.start = self.bucket = np.zeros(0, np.int64)
        self.name = self._from = self._to = np.zeros(0, np.int64)
        flat, offsets = words.split(texts)
        if len(flat) < k:
            return
        code, distinct = words.codes(flat)
        hashes = words.hashes(distinct)[code]
        runs = _run_hashes(hashes, m) >> np.uint64(1)
        if len(common):  # common runs sort behind all others
            maybe = np.zeros(1 << 16, dtype=bool)
            maybe[common & np.uint64(0xFFFF)] = True
            at = np.flatnonzero(maybe[runs & np.uint64(0xFFFF)])
            at = at[np.isin(runs[at], common)]
            runs[at] |= np.uint64(1 << 63)
        least = _sliding_min(runs, k - m + 1)  # of the window from each position on
        text_of = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        whole = np.flatnonzero(text_of[:len(least)] == text_of[k - 1:])  # windows inside one text
        if not len(whole):
            return
        value, text = least[whole], text_of[whole]
        level = np.zeros(len(whole), dtype=np.int8)
        for i, (longer, crowded) in enumerate(zip(((m + k + 1) // 2, k), hot)):
            at = np.flatnonzero((level == i) & np.isin(value % np.uint64(buckets), crowded))
            if len(at):
                value[at] = _sliding_min(_run_hashes(hashes, longer), k - longer + 1)[whole[at]]
                level[at] = i + 1
        first = np.concatenate([[True], (value[1:] != value[:-1]) | (text[1:] != text[:-1]) | (level[1:] != level[:-1])])
        starts = np.flatnonzero(first)
        since = np.arange(len(whole)) - np.repeat(starts, np.diff(np.append(starts, len(whole))))
        starts = np.flatnonzero(since % k == 0)  # at most k windows, so covered words have no gap
        begin = whole[starts]
        end = begin + np.diff(np.append(starts, len(whole))) + k - 2  # its last word
        self.text, self.bucket = text[starts].astype(np.int64), (value[starts] % np.uint64(buckets)).astype(np.int64)
        self.start = begin - offsets[:-1][self.text]
        # byte offsets of the words when all are joined by one space
        length = np.asarray(pc.binary_length(flat)).astype(np.int64)
        place = np.cumsum(length + 1) - length - 1
        self._from, self._to = place[begin], place[end] + length[end]
        # equal strings have equal names; that different ones may share a name matters to measuring only
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(hashes) * _powers(_BASE, len(hashes)))])
        self.name = (sums[end + 1] - sums[begin]) * _powers(_BASE_INVERSE, len(hashes))[begin]
        one = pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)
        self._joined = pc.binary_join(one, pa.scalar(" ", pa.large_string()))[0].as_buffer().to_pybytes()

    def strings(self, at: np.ndarray | None = None) -> list[bytes]:
        a, b = (self._from, self._to) if at is None else (self._from[at], self._to[at])
        return [self._joined[x:y] for x, y in zip(a.tolist(), b.tolist())]


def _pack(strings: list[bytes], n: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> bytes:
    """One bucket's share of a batch. docs, starts: of each string's occurrences, or its first and last document."""
    body = b"".join([struct.pack("<III", len(n), len(docs), len(starts)), n.astype("<i4").tobytes(),
                     docs.astype("<i8").tobytes(), starts.astype("<i4").tobytes(), b"\n".join(strings)])
    return b"z" + zstandard.ZstdCompressor(level=1).compress(body) if len(body) > 400 else b"r" + body


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    body = zstandard.ZstdDecompressor().decompress(blob[1:]) if blob[:1] == b"z" else blob[1:]
    e, d, s = struct.unpack_from("<III", body)
    at = 12 + 4 * e
    return (np.frombuffer(body, "<i4", e, 12), np.frombuffer(body, "<i8", d, at), np.frombuffer(body, "<i4", s, at + 8 * d),
            body[at + 8 * d + 4 * s:])


def _summed(bucket: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct buckets, the sum of each one's sizes)"""
    order = np.argsort(bucket, kind="stable")
    bucket, size = bucket[order], size[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    return bucket[first], np.add.reduceat(size, first) if len(first) else size


def _measuring(k: int, m: int, common: np.ndarray, buckets: int, hot: tuple):
    """Batch -> bytes of the distinct strings that it would send to each bucket (a bucket may come several times)."""

    def run(batches):
        bucket = size = np.zeros(0, dtype=np.int64)

        def loads():
            for i in range(0, len(bucket), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(bucket[i:i + (1 << 16)]), pa.array(size[i:i + (1 << 16)])], ["bucket", "bytes"])

        for batch in batches:
            for part in words.slices(batch, 1, _ROWS, _BYTES):
                kmers = SuperKmers(part.column(1), k, m, common, buckets, hot)
                _, once = np.unique(kmers.name, return_index=True)
                bucket, size = _summed(np.concatenate([bucket, kmers.bucket[once]]), np.concatenate([size, (kmers._to - kmers._from)[once]]))
                if len(bucket) > _LOADS:  # whatever the number of buckets, a task holds few of them
                    yield from loads()
                    bucket = size = np.zeros(0, dtype=np.int64)
        yield from loads()

    return run


def _crowded_buckets(src: DataFrame, k: int, m: int, common: np.ndarray, buckets: int) -> tuple:
    """For the minimisers and the longer ones, the numbers of the buckets that get more than SPLIT_BYTES; () if none does."""
    hot: tuple = ()
    for _ in range(2):
        loads = src.mapInArrow(_measuring(k, m, common, buckets, hot), "bucket long, bytes long").groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
        crowded = np.array(sorted(r[0] for r in loads.where(F.col("bytes") > SPLIT_BYTES).select("bucket").collect()), dtype=np.uint64)
        if not len(crowded):
            break
        hot += (crowded,)
    return hot


def _sending(k: int, m: int, common: np.ndarray, buckets: int, hot: tuple):
    """Batch -> for each bucket its distinct packed strings with their documents."""

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, 1, _ROWS, _BYTES):
                kmers = SuperKmers(part.column(1), k, m, common, buckets, hot)
                if not len(kmers.text):
                    continue
                doc = np.asarray(part.column(0))[kmers.text]
                strings = kmers.strings()
                seen: dict[bytes, int] = {}
                name = np.array([seen.setdefault(s, len(seen)) for s in strings])  # equal strings share a bucket
                distinct, bucket = list(seen), np.zeros(len(seen), np.int64)
                bucket[name] = kmers.bucket
                order = np.lexsort((doc, name, bucket[name]))  # by bucket, string, document
                name, doc, start = name[order], doc[order], kmers.start[order]
                edge = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
                n = np.diff(np.append(edge, len(name)))
                few = np.repeat(n <= LISTED, n)
                ends = np.zeros(len(name), dtype=bool)  # first and last document of the other strings
                ends[edge] = ends[edge + n - 1] = True
                held = few | ends
                entry = np.repeat(np.arange(len(n)), n)
                strings = [distinct[i] for i in name[edge].tolist()]
                doc, start, of_doc, of_start = doc[held], start[few], entry[held], entry[few]
                of = bucket[name[edge]]
                cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
                bounds = np.append(cut, len(n))
                d_at, s_at = np.searchsorted(of_doc, bounds), np.searchsorted(of_start, bounds)
                blobs = [_pack(strings[a:b], n[a:b], doc[c:d], start[e:f]) for a, b, c, d, e, f in zip(
                    *(x.tolist() for x in (bounds[:-1], bounds[1:], d_at[:-1], d_at[1:], s_at[:-1], s_at[1:])))]
                yield pa.RecordBatch.from_arrays([pa.array(of[cut]), pa.array(blobs, pa.binary())], ["bucket", "packed"])

    return run


def window_names(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): ``order`` sorts the byte ranges so that equal ones are neighbours; ``first`` marks each new one."""
    raw = np.frombuffer(text, np.uint8)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[raw] * _powers(_BASE, len(raw)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(raw))[starts]
    order = np.argsort(h, kind="stable")
    first = np.ones(len(order), dtype=bool)
    first[1:] = h[order][1:] != h[order][:-1]
    a, b = starts[order].tolist(), ends[order].tolist()
    if all(text[a[i]:b[i]] == text[a[i - 1]:b[i - 1]] for i in np.flatnonzero(~first).tolist()):
        return order, first
    keys: dict[bytes, int] = {}  # two different windows share a hash: name them by their bytes
    name = np.array([keys.setdefault(text[x:y], len(keys)) for x, y in zip(starts.tolist(), ends.tolist())])
    order = np.argsort(name, kind="stable")
    return order, np.concatenate([[True], np.diff(name[order]) != 0])


def _counting(k: int):
    """Bucket -> what its occurrences lose (doc, a, b), and the strings whose occurrences are elsewhere (sh, n, firsts)."""
    names = ["doc", "a", "b", "sh", "h", "n", "firsts"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def run(table: pa.Table) -> pa.Table:
        parts = [_unpack(b) for b in table.column("packed").to_pylist()]
        n, docs, starts = (np.concatenate([p[i] for p in parts]) for i in range(3))
        text = b"\n".join(p[3] for p in parts) + b"\n"
        raw = np.frombuffer(text, np.uint8)
        stop = np.flatnonzero((raw == 32) | (raw == 10))  # ends of the words
        last = np.flatnonzero(raw[stop] == 10)  # each string's last word
        begin = np.concatenate([[0], stop[:-1] + 1])
        word0 = np.concatenate([[0], last[:-1] + 1])
        count = last - word0 + 2 - k  # windows of each string
        entry = np.repeat(np.arange(len(n)), count)
        base = np.cumsum(count) - count
        at = np.arange(len(entry)) - base[entry] + word0[entry]
        order, first = window_names(text, begin[at], stop[at + k - 1])
        few = n <= LISTED
        held = np.where(few, n, 2)
        doc_at = np.cumsum(held) - held
        low, high = docs[doc_at][entry][order], docs[doc_at + held - 1][entry][order]  # documents come sorted
        edge = np.flatnonzero(first)
        low, high = np.minimum.reduceat(low, edge), np.maximum.reduceat(high, edge)
        low[low == high] = _NONE  # in one document only
        lowest = np.empty(len(order), dtype=np.int64)
        lowest[order] = np.repeat(low, np.diff(np.append(edge, len(order))))
        hit = np.zeros(len(n), dtype=bool)
        hit[entry[lowest != _NONE]] = True

        # occurrences that came along: the span of their windows that an earlier document has
        chosen = np.flatnonzero(hit & few)
        occ = np.repeat(chosen, n[chosen])
        nth = np.arange(len(occ)) - np.repeat(np.cumsum(n[chosen]) - n[chosen], n[chosen])
        doc = docs[doc_at[occ] + nth]
        in_list = np.cumsum(np.where(few, n, 0)) - np.where(few, n, 0)
        start = starts[in_list[occ] + nth].astype(np.int64)
        reps = count[occ]
        window = np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps, reps)
        gone = lowest[np.repeat(base[occ], reps) + window] < np.repeat(doc, reps)
        if len(occ):
            cut = np.cumsum(reps) - reps
            a = np.minimum.reduceat(np.where(gone, window, k + 1), cut)
            b = np.maximum.reduceat(np.where(gone, window, -1), cut)
            lose = b >= 0
            doc, a, b = doc[lose], (start + a)[lose], (start + b + k)[lose]
        else:
            a = b = np.zeros(0, np.int64)

        # the others, once a string
        byte0, byte1 = begin[word0], stop[last]
        strings: dict[bytes, list] = {}
        for i in np.flatnonzero(hit & ~few).tolist():
            strings.setdefault(text[byte0[i]:byte1[i]], [i, 0])[1] += int(n[i])
        none = [None] * len(doc)
        sh = [xxhash.xxh128_digest(s) for s in strings]
        cols = [doc.tolist() + [None] * len(sh), a.tolist() + [None] * len(sh), b.tolist() + [None] * len(sh), none + sh,
                none + [_short(x) for x in sh], none + [c for _, c in strings.values()],
                none + [lowest[base[i]:base[i] + count[i]].tolist() for i, _ in strings.values()]]
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names)

    return run


def _short(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _occurring(k: int, m: int, common: np.ndarray, buckets: int, hot: tuple, bits: np.ndarray):
    """Batch -> (string hash, document, start) of the super-k-mers that the bitmap lets through."""

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, 1, _ROWS, _BYTES):
                kmers = SuperKmers(part.column(1), k, m, common, buckets, hot)
                if not len(kmers.text):
                    continue
                sh = [xxhash.xxh128_digest(s) for s in kmers.strings()]
                h = np.frombuffer(b"".join(sh), "<i8")[::2]
                at = np.flatnonzero(bits[h % len(bits)] >> ((h >> 40) % 64).astype(np.uint64) & np.uint64(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([sh[i] for i in at.tolist()], pa.binary()), part.column(0).take(pa.array(kmers.text[at])),
                     pa.array(kmers.start[at], pa.int64())], ["sh", "_id", "start"])

    return run


def _removing(batches):
    """(.., text, cuts) -> words, removed words and the kept words joined by one space."""
    for batch in batches:
        removed, total, kept = [], [], []
        for text, cuts in zip(batch.column("_t").to_pylist(), batch.column("cuts").to_pylist()):
            w = (text or "").encode().split()
            total.append(len(w))
            stay, at = [], 0
            for a, b in sorted((c["a"], c["b"]) for c in cuts or ()):
                if a > at:
                    stay += w[at:a]
                at = max(at, b)
            stay = stay + w[at:] if at else w
            removed.append(len(w) - len(stay))
            kept.append(b" ".join(stay).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            ["_id", "n_words", "n_removed", "kept_text"])


def _common_runs(src: DataFrame, m: int) -> np.ndarray:
    """Hashes of word runs in COMMON_SHARE of a sample of about SAMPLE_DOCS documents, COMMON_MAX at most."""
    n = src.count()
    if not n:
        return np.zeros(0, np.uint64)
    steps = max(1, n // SAMPLE_DOCS)

    def run(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                flat, _ = words.split(pa.array([text], pa.string()))
                code, distinct = words.codes(flat)
                if len(code) >= m:
                    got = np.unique(_run_hashes(words.hashes(distinct)[code], m) >> np.uint64(1))
                    yield pa.RecordBatch.from_arrays([pa.array(got.view(np.int64))], ["run"])

    sample = src.where(F.pmod(F.xxhash64("_id"), F.lit(steps)) == 0).select("_t")
    seen = (sample.mapInArrow(run, "run long").groupBy("run").count()
            .where(F.col("count") >= max(5, int(COMMON_SHARE * n / steps))).orderBy(F.desc("count"), "run").limit(COMMON_MAX))
    return np.array([r[0] for r in seen.select("run").collect()], dtype=np.int64).view(np.uint64)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WINDOW,
                    m: int = MINIMISER_WORDS) -> DataFrame:
    """``(id_col, n_words, n_removed, kept_text)``, one row per input row.

    Words (``[^\\x20\\x09-\\x0D]+``) covered by a window of ``k`` words that
    also starts in a row with a smaller id are removed; the rest are joined by
    one space. Null and empty texts have no words. Rows that share an id count
    as one document: none of them removes words of another, and each loses what
    a smaller id has. Rows with a null id keep all words and remove none.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_t"))
    src_known = src.where("_id is not null")
    common = _common_runs(src_known, m)
    volume = src_known.agg(F.sum(F.octet_length("_t"))).first()[0] or 0
    buckets = max(1, -(-volume // BUCKET_BYTES))
    hot = _crowded_buckets(src_known, k, m, common, buckets)

    sent = src_known.mapInArrow(_sending(k, m, common, buckets, hot), "bucket long, packed binary")
    found = sent.groupBy("bucket").applyInArrow(_counting(k), "doc long, a int, b int, sh binary, h long, n long, firsts array<long>")
    found = stage(found, "substring-found")
    del sent
    release(spark)  # the packed strings' shuffle files
    cuts = found.where("doc is not null").select(F.col("doc").alias("_id"), "a", "b")

    # strings that some batch repeats often: their occurrences, from a second pass
    crowded = found.where("sh is not null").select("sh", "h", "n", "firsts")
    bits = np.zeros(BITMAP_WORDS, dtype=np.uint64)
    for word, value in bit_words(crowded, "h", BITMAP_WORDS).collect():  # at most BITMAP_WORDS rows
        bits[word] = np.uint64(value & (2**64 - 1))
    if bits.any():
        crowded = stage(crowded.groupBy("sh").agg(F.sum("n").alias("n"), F.first("firsts").alias("firsts")), "substring-crowded")
        places = src_known.mapInArrow(_occurring(k, m, common, buckets, hot, bits), "sh binary, _id long, start long")
        marks = skew_join_once(places, crowded, "sh", "n", "firsts", salt="_id")
        # a string's windows are at most k, so what its marked windows cover has no gap
        marks = marks.withColumn("flags", F.transform("firsts", lambda d: d < F.col("_id"))).where(F.array_contains("flags", True))
        i, j = F.array_position("flags", True) - 1, F.size("flags") - F.array_position(F.reverse("flags"), True)
        cuts = cuts.unionByName(marks.select("_id", (F.col("start") + i).cast("int").alias("a"), (F.col("start") + j + k).cast("int").alias("b")))
    cuts = cuts.groupBy("_id").agg(F.collect_set(F.struct("a", "b")).alias("cuts"))
    out = src.join(cuts, "_id", "left").select("_id", "_t", "cuts")
    return out.mapInArrow(_removing, "_id long, n_words long, n_removed long, kept_text string").withColumnRenamed("_id", id_col)
