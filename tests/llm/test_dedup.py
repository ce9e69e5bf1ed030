"""Exact, line, SimHash and substring deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from threadloom.llm import exact_dedup as exact
from threadloom.llm import line_dedup as lines
from threadloom.llm import simhash, substring_dedup as substring
from threadloom.llm.common import connected_components
from threadloom.llm.queries import REGISTRY

WS = " \t\n\x0b\x0c\r"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact_brute(docs):
    norm = [re.sub(f"[{WS}]", "", d[1] or "") for d in docs]
    groups = defaultdict(list)
    for i, n in enumerate(norm):
        groups[n].append(i)
    best = {n: min(g, key=lambda i: (-len(docs[i][1] or ""), docs[i][0] is None, docs[i][0] or 0)) for n, g in groups.items()}
    return norm, groups, best


@pytest.mark.parametrize("bitmap", [None, 1])
def test_exact(spark, mini, docs, monkeypatch, bitmap):
    if bitmap:  # a bitmap with every bit set lets all rows through and changes nothing
        monkeypatch.setattr(exact, "BITMAP_WORDS", bitmap)
    norm, groups, best = exact_brute(docs)
    got = REGISTRY["op5_exact_dedup"](spark, mini).collect()
    want = Counter((d[0], docs[best[n]][0], len(groups[n]), sha(n)) for d, n in zip(docs, norm))
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(sha(n) for n in groups)  # exactly one row of each group
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def line_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))


def line_brute(texts, min_docs):
    split = [(t or "").split("\n") for t in texts]
    seen = Counter(k for ls in split for k in {line_key(x) for x in ls} if k)
    return [(len(ls), "\n".join(k := [x for x in ls if seen[line_key(x)] < min_docs]), len(ls) - len(k)) for ls in split]


def test_lines(spark, mini, docs):
    got = rows(REGISTRY["op3_line_dedup"](spark, mini))
    want = line_brute([d[1] for d in docs], 10)
    assert got == sorted(((d[0], n, dropped, sha(kept)) for d, (n, kept, dropped) in zip(docs, want)), key=repr)
    assert any(d for _, _, d in want)


def test_line_runs_compact_over_many_batches(spark):
    r = random.Random(1)
    texts = ["\n".join(r.choice("abcdefghijklmnopq") * 2 for _ in range(r.randint(0, 6))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for min_docs, batches, fanout in ((2, 7, 2), (20, 5, 3), (30, 1, 2)):
        got = rows(lines.line_dedup(df, min_docs=min_docs, batches=batches, fanout=fanout).select("doc_id", "n_lines", "kept_text", "n_dropped"))
        assert got == sorted(((i, *w) for i, w in enumerate(line_brute(texts, min_docs))), key=repr)


def test_line_dedup_replaces_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", "mine", 5, 6)], "doc_id long, text string, kept_text string, _id int, _pos int")
    out = lines.line_dedup(df)
    assert sorted(out.columns) == sorted(["doc_id", "text", "_id", "_pos", "n_lines", "n_dropped", "kept_text"])
    assert out.first().kept_text == "a"


def fingerprint_brute(text):
    w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in re.findall(f"[^{WS}]+", text or "")]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    out = defaultdict(list)
    for i in range(n):
        out[find(i)].append(i)
    return out.values()


def test_simhash(spark, mini, docs):
    fps = [fingerprint_brute(d[1]) for d in docs]
    want = []
    for group in components(len(docs), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3):
        ids = [docs[i][0] for i in group if docs[i][0] is not None]
        want += [(docs[i][0], f"{fps[i]:016x}", min(ids, default=None)) for i in group]
    assert rows(REGISTRY["op10_simhash_near_dedup"](spark, mini)) == sorted(want, key=repr)


@pytest.mark.parametrize("dense", [simhash.DENSE, 3, 0])
def test_links_join_all_pairs_whatever_is_crowded(spark, dense):
    r = random.Random(3)
    centres = [r.getrandbits(64) for _ in range(6)]
    fps = {0, (1 << 64) - 1}
    for c in centres:
        for _ in range(25):
            x = c
            for _ in range(r.randint(0, 5)):
                x ^= 1 << r.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.hamming_links(spark.createDataFrame([(s,) for s in signed], "fp long"), dense)
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in edges.collect())
    got = defaultdict(set)
    for node, root in connected_components(edges, "test").collect():
        got[root].add(node)
    want = {frozenset(signed[i] for i in g) for g in components(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3) if len(g) > 1}
    assert {frozenset(g) for g in got.values()} == want
    assert all(root == min(g) for root, g in got.items())


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (-5, 139)]
    got = {(r.node, r.root) for r in connected_components(spark.createDataFrame(edges, "u long, v long"), "test").collect()}
    assert got == {(i, 0) for i in range(61)} | {(i, -5) for i in [-5, *range(100, 140)]}


def substring_brute(docs, k=13):
    toks = [re.findall(f"[^{WS}]+", d[1] or "") for d in docs]
    first = {}
    for d, w in zip(docs, toks):
        for i in range(len(w) - k + 1):
            if d[0] is not None:
                key = tuple(w[i:i + k])
                first[key] = min(first.get(key, d[0]), d[0])
    out = []
    for d, w in zip(docs, toks):
        gone = set()
        for i in range(len(w) - k + 1):
            if d[0] is not None and first[tuple(w[i:i + k])] < d[0]:
                gone.update(range(i, i + k))
        out.append((d[0], len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=repr)


def test_substring(spark, mini, docs):
    want = substring_brute(docs)
    assert rows(REGISTRY["op7_substring_dedup"](spark, mini)) == want
    assert sum(w[2] > 0 for w in want) > 30


@pytest.mark.parametrize("share,m", [(0.0, 1), (0.0, 5), (1.1, 13)])
def test_substring_is_the_same_whatever_counts_as_common(spark, docs, monkeypatch, share, m):
    monkeypatch.setattr(substring, "COMMON_SHARE", share)
    monkeypatch.setattr(substring, "BUCKET_BYTES", 3000)
    some = [d for d in docs if len(d[1] or "") < 3000]
    df = spark.createDataFrame([(d[0], d[1]) for d in some], "doc_id long, text string")
    got = [(a, b, c, sha(t)) for a, b, c, t in substring.substring_dedup(df, m=m).collect()]
    assert sorted(got, key=repr) == substring_brute(some)


@pytest.mark.parametrize("letters", [2, 10])
def test_substring_splits_crowded_buckets(spark, monkeypatch, letters):
    counting = substring._counting

    def watched(k):
        run = counting(k)

        def measured(table):
            size = sum(len(substring._unpack(b)[3]) for b in table.column("packed").to_pylist())
            assert size < 35000, f"a bucket of {size} bytes"
            return run(table)

        return measured

    monkeypatch.setattr(substring, "_counting", watched)
    monkeypatch.setattr(substring, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(substring, "SPLIT_BYTES", 16000, raising=False)
    r = random.Random(letters)
    texts = [" ".join(str(r.randrange(letters)) for _ in range(400)) for _ in range(60)]  # every run of two words is common
    texts += texts[:5] + [" ".join(f"w{r.randrange(500)}" for _ in range(200)) for _ in range(60)]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = [(a, b, c, sha(t)) for a, b, c, t in substring.substring_dedup(df).collect()]
    assert sorted(got, key=repr) == substring_brute(docs)
