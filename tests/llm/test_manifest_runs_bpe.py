"""Merkle manifest, periodic runs and BPE against brute force, the tokenizers library and exact round trips."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadloom.llm import bpe, merkle_manifest as merkle, periodic_runs as periodic
from threadloom.llm.queries import REGISTRY, vocabulary

WS = " \t\n\x0b\x0c\r"
BYTES = vocabulary("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(f"[^{WS}]+", text or "")


# merkle manifest

def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_brute(leaves, fanout):
    """(root, siblings of each leaf level by level as (left, right))"""
    proofs, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, a in enumerate(at):
            lo = a - a % fanout
            proofs[i].append(("".join(level[lo:a]), "".join(level[a + 1:lo + fanout])))
        level = [sha("".join(level[i:i + fanout])) for i in range(0, len(level), fanout)]
        at = [a // fanout for a in at]
    return level[0], proofs


def manifest_brute(docs, fanout=8):
    """rows (doc_id, source, lang, n_chars, text) -> (row, leaf, subroot, root, proof)"""
    trees = defaultdict(list)
    for d in docs:
        trees[d[2]].append((d[0] is not None, d[0] or 0, leaf(d), d))
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    built = [tree_brute([x[2] for x in sorted(trees[k], key=lambda x: x[:3])], fanout) for k in order]
    root, upper = tree_brute([b[0] for b in built], fanout)
    return [(x[3], x[2], sub, root, proof + up) for k, (sub, proofs), up in zip(order, built, upper)
            for x, proof in zip(sorted(trees[k], key=lambda x: x[:3]), proofs)]


def fold(node, proof):
    for left, right in proof:
        node = sha(left + node + right)
    return node


def test_manifest_query(spark, mini, docs):
    want = Counter()
    for row, h, sub, root, proof in manifest_brute([(d[0], d[3], d[2], d[4], d[1]) for d in docs]):
        forged = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
        text = row[4] if not forged or row[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
        top = fold(leaf((*row[:4], text)), proof)
        want[(row[0], h, sub, root, sha("".join(a + b for a, b in proof)), top, top == root)] += 1
    got = REGISTRY["op11_merkle_manifest"](spark, mini).collect()
    assert Counter(tuple(r) for r in got) == want
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("fanout,trees", [(2, 5), (3, 11), (8, 1)])
def test_manifest_of_many_shapes(spark, fanout, trees):
    r = random.Random(fanout * 100 + trees)
    rows = [(r.choice([None, *range(40)]), "s", r.choice([None, "", *[f"l{i}" for i in range(trees)]][:trees]), None, r.choice([None, "a", "b"]))
            for _ in range(r.choice([1, 37, 130]))]
    df = spark.createDataFrame([(*x, "noise", 1) for x in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, rank int")
    out = merkle.merkle_manifest(df, fanout=fanout)
    got = out.withColumn("top", merkle.folded(F.col("leaf"), F.col("proof"))).collect()
    assert Counter((x.doc_id, x.lang, x.leaf, x.subroot, x.root, tuple(tuple(p) for p in x.proof)) for x in got) == Counter(
        (d[0], d[2], h, sub, root, tuple(proof)) for d, h, sub, root, proof in manifest_brute(rows, fanout))
    assert all(x.top == x.root for x in got)


def test_manifest_moves_no_text(spark, mini):
    df = spark.read.parquet(f"{mini}/documents.parquet")
    out = merkle.merkle_manifest(df)
    assert "text" not in out._jdf.queryExecution().executedPlan().toString()  # the leaves' stage table is all that is read


# periodic runs

def runs_brute(ws, min_words=6, min_exponent=4):
    codes = {w: i for i, w in enumerate(dict.fromkeys(ws))}
    c, found = np.array([codes[w] for w in ws], dtype=np.int64), {}
    for q in range(1, int(len(c) // min_exponent) + 1):
        same = np.concatenate([[False], c[:-q] == c[q:], [False]])
        for s, e in zip(np.flatnonzero(same[1:] & ~same[:-1]).tolist(), np.flatnonzero(same[:-1] & ~same[1:]).tolist()):
            n = e - s + q
            if n >= max(min_words, min_exponent * q):
                found.setdefault((s, n), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse_brute(ws, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def test_runs_query(spark, mini, docs):
    want = Counter()
    for doc, text, *_ in docs:
        ws = words(text)
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 == 0 and ws:
            g = h // 10
            a = g % len(ws)
            p = 1 + (len(ws) - a) // (3 + g % 8)
            ws = ws[:a] + [ws[a + (i - a) % p] for i in range(a, len(ws))]
        runs = runs_brute(ws)
        s, n, q = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        want[(doc, len(runs), s, n, q, n and 1000 * n // q, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(collapse_brute(ws, runs)))] += 1
    got = REGISTRY["op12_periodic_runs"](spark, mini).collect()
    assert Counter(tuple(r) for r in got) == want
    assert sum(r.n_runs for r in got) > 5


@given(st.lists(st.one_of(st.lists(st.integers(0, 2), max_size=40), st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 9))
                          .map(lambda x: x[0] * x[1])), max_size=5), st.sampled_from([(6, 4), (1, 2), (5, 2.5), (2, 3)]))
@settings(max_examples=300, deadline=None)
def test_runs_of_any_words(texts, limits):
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    code = np.array([x for t in texts for x in t], dtype=np.int64)
    want = [(i, *x) for i, t in enumerate(texts) for x in (runs_brute(t, *limits) if t else [])]
    assert periodic.runs_of(code, offsets, *limits) == want


def test_long_periodic_texts():
    for code in (np.zeros(300_000, dtype=np.int64), np.arange(300_000) % 977):
        q = int(code.max()) + 1
        assert periodic.runs_of(code, np.array([0, len(code)])) == [(0, 0, len(code), q)]


def test_runs_pass_columns_through(spark):
    df = spark.createDataFrame([(1, "a b a b a b a b x", "mine", 7)], "doc_id long, text string, runs string, kept int")
    row = periodic.periodic_runs(df).first()
    assert row.asDict(True) == {"doc_id": 1, "text": "a b a b a b a b x", "kept": 7, "runs": [{"start": 0, "length": 8, "period": 2}],
                                "n_words": 9, "kept_text": "a b x"}
    with pytest.raises(ValueError):
        periodic.periodic_runs(df, min_exponent=1.5)


# BPE

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def ours():
    return bpe.Vocabulary(BYTES)


def ids_of(vocabulary, text):
    return np.frombuffer(vocabulary.encode(text), dtype=np.int32).tolist()


def text_of(vocabulary, *lists):
    return vocabulary.decode(np.array([i for ids in lists for i in ids], dtype=np.int64), np.array([len(ids) for ids in lists], dtype=np.int64)).to_pylist()


ODD = st.sampled_from([*"abcdefghij ABC  \n\t\x0b'12.,!-éüßжя漢字  　\x85\x1c😀́½²Ⅷ‍՘\U00031350", "'s", "'LL", " the ", " and ", "<|endoftext|>",
                       "<|endof", "  ", "\n\n", "ing", "tion"])


@given(st.lists(ODD, max_size=25).map("".join))
@settings(max_examples=600, deadline=None)
def test_bpe_equals_the_library(library, ours, text):
    got = ids_of(ours, text)
    assert got == library.encode(text, add_special_tokens=False).ids
    assert text_of(ours, got) == [library.decode(got, skip_special_tokens=False)] == [text]


@given(st.lists(st.integers(0, 50256), max_size=12))
@settings(max_examples=200, deadline=None)
def test_any_ids_decode_as_in_the_library(library, ours, ids):
    assert text_of(ours, ids, [], ids) == [library.decode(ids, skip_special_tokens=False), "", library.decode(ids, skip_special_tokens=False)]


def test_long_pre_tokens(library, ours):
    for text in ("a" * 100_000, "ab" * 20_000, "!?" * 5000, "\n " * 5000, " " * 5000):
        assert ids_of(ours, text) == library.encode(text, add_special_tokens=False).ids


def test_bpe_small_cache(library, monkeypatch):
    monkeypatch.setattr(bpe, "_CACHE", 3)
    fresh = bpe.Vocabulary(BYTES)
    text = " ".join(random.Random(1).choices(["one", "two", "three", "four,", "five", "six"], k=300))
    assert ids_of(fresh, text) == library.encode(text, add_special_tokens=False).ids
    assert len(fresh.new) <= 3 and len(fresh.old) <= 3


def test_bpe_query(spark, mini, docs, library):
    want = Counter()
    for doc, text, *_ in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[(doc, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))] += 1
    assert Counter(tuple(r) for r in REGISTRY["op13_bpe"](spark, mini).collect()) == want


def test_decode_skips_what_it_does_not_know(spark):
    df = spark.createDataFrame([(1, [31373, None, 60000, -1, 995], "x"), (2, None, "y"), (3, [], "z"), (4, [50256], "w")], "doc_id long, ids array<int>, decoded string")
    got = bpe.decode_documents(df, BYTES).collect()
    assert [(r.doc_id, r.decoded) for r in sorted(got)] == [(1, "hello world"), (2, ""), (3, ""), (4, "<|endoftext|>")]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(vocabulary())
