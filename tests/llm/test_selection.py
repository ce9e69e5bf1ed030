"""Sharding, mixing, packing, search, quality, language and the empty tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadloom.llm import language_id as language
from threadloom.llm import mixing, packing, quality_knn as quality, sharding, topk_search as search, words
from threadloom.llm.queries import REGISTRY, vocabulary

WS = " \t\n\x0b\x0c\r"


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_empty_tables(spark, empty, name):
    assert REGISTRY[name](spark, empty).collect() == []


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é \t\n\x0b\x0c\r\x1c\x85 ", max_size=12)), max_size=8))
@settings(max_examples=150, deadline=None)
def test_words_are_runs_without_ascii_space(texts):
    flat, at = words.split(pa.array(texts, pa.string()))
    got = [flat.to_pylist()[a:b] for a, b in zip(at, at[1:])]
    assert got == [re.findall(f"[^{WS}]+", t or "") for t in texts]


# sharding

def test_sharding_keeps_groups_and_bytes_even(spark, mini, docs):
    got = REGISTRY["op1_sharding"](spark, mini).collect()
    want = Counter((d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)} and all(0 <= r.shard < 8 for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def spread(sizes):
    return max(sizes) / (sum(sizes) / len(sizes)) - 1, 1 - min(sizes) / (sum(sizes) / len(sizes))


def test_sharding_balance_with_a_hot_group(spark):
    r = random.Random(2)
    texts = ["hot" * 40] * 1000 + [f"pair {i % 300} " + "x" * (i % 300) for i in range(600)] + [f"{i} " + "y" * r.randint(1, 400) for i in range(1400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sharding.shard_documents(df).collect()
    by, groups = Counter(), defaultdict(set)
    for x in got:
        by[x.shard] += x.size
        groups[texts[x.doc_id]].add(x.shard)
    assert max(spread([by[i] for i in range(8)])) < 0.01
    assert len(groups["hot" * 40]) <= 5  # a third of the rows: 2.4 shards' worth
    cut = [t for t, s in groups.items() if t.startswith("pair") and len(s) > 1]
    assert not cut


def test_sharding_when_everything_is_linked(spark):
    df = spark.createDataFrame([(i, "same text") for i in range(801)], "doc_id long, text string")
    sizes = Counter(x.shard for x in sharding.shard_documents(df).collect())
    assert max(sizes.values()) - min(sizes.values()) <= 2
    rows = [(i, 10, [f"a{i // 7}", f"b{i // 5}"]) for i in range(70)]  # several keys a document: one long chain
    out = sharding.balanced_shards(spark.createDataFrame(rows, "row long, size long, keys array<string>"), 5).collect()
    assert Counter(x.shard for x in out) == {i: 14 for i in range(5)}


# mixing

@given(st.integers(1, 300), st.integers(0, 2**62))
@settings(max_examples=60, deadline=None)
def test_permute_is_a_permutation(n, key):
    p = mixing.permute(np.arange(n), n, key)
    assert sorted(p.tolist()) == list(range(n))
    assert mixing.permute(p, n, key, inverse=True).tolist() == list(range(n))


@given(st.integers(0, 500), st.floats(0, 3), st.integers(1, 40), st.integers(0, 9))
@settings(max_examples=150, deadline=None)
def test_slots_take_the_target_to_the_word(size, share, block, sid):
    target = size * share
    taken, per_block = 0, Counter()
    blocks, slots, last = mixing.slot_plan(sid, size, target, block, 1)
    stretches = [(sid, size, blocks, slots, last, a // 7, a, 7) for a in range(0, slots, 7)]
    for part in mixing._dealing(block, 1)([pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*stretches)] or [pa.array([], pa.int64())] * 8,
                                                                      [*mixing._PLAN, "shard", "start", "n"])]):
        for row in part.to_pylist():
            taken += row["words"]
            per_block[row["block"]] += 1
            assert row["words"] <= min(block, size - row["block"] * block) and row["shard"] == row["slot"] // 7
    assert taken == math.floor(target + 0.5)
    assert max(per_block.values(), default=0) <= 3


@pytest.mark.parametrize("group", [1, 2, 100])
def test_shards_draw_their_slots_over_the_sources(spark, group):
    rows = [(0, 40_000, 80_000.0), (1, 50_000, 50_000.0), (2, 0, 0.0), (3, 9_000, 27_000.0), (4, 31, 31.0)]
    sources = spark.createDataFrame(rows, "sid long, size long, target double")
    got = mixing.drawn_slots(sources, block=10, seed=3, shard_slots=100, group_sources=group).collect()
    slots, shards = defaultdict(list), Counter()
    for r in got:
        slots[r.sid].append(r.slot)
        shards[r.shard] += 1
    plan = {sid: mixing.slot_plan(sid, size, target, 10, 3)[1] for sid, size, target in rows}
    assert {s: sorted(x) for s, x in slots.items()} == {s: list(range(n)) for s, n in plan.items() if n}  # every slot is in one shard
    whole = sum(plan.values()) // 100
    assert all(n <= 100 for n in shards.values()) and sum(shards[i] for i in range(whole)) >= 0.97 * 100 * whole
    mine = Counter((r.shard, r.sid) for r in got)
    share = [mine[i, 0] / 100 for i in range(whole - 20)]  # a binomial draw each: mean and spread
    p = plan[0] / sum(plan.values())
    assert abs(np.mean(share) - p) < 0.03 and 0.5 < np.var(share) / (p * (1 - p) / 100) < 2


@pytest.mark.parametrize("group", [1, 2, 100])
def test_shards_of_many_ranges_draw_by_their_own_group(spark, group):
    rows = [(0, 3_000, 6_000.0), (1, 2_500, 2_500.0), (2, 0, 0.0), (3, 300, 900.0), (4, 31, 31.0)]
    sources = spark.createDataFrame(rows, "sid long, size long, target double")
    plan = {sid: mixing.slot_plan(sid, size, target, 1, 3)[1] for sid, size, target in rows}
    shards = sum(plan.values()) // 10
    assert shards > 3 * mixing.SPAN_SHARDS
    got = mixing.drawn_slots(sources, block=1, seed=3, shard_slots=10, group_sources=group).collect()
    assert Counter((r.sid, r.slot) for r in got) == Counter((sid, i) for sid, n in plan.items() for i in range(n))
    # every shard as the groups' draws have it; sources run out of slots in the order of shards
    groups = [[s for s in plan if s // group == g and plan[s]] for g in sorted({s // group for s in plan if plan[s]})]
    shares = np.array([sum(plan[s] for s in ids) for ids in groups], dtype=float)
    want, used = Counter(), Counter()
    for g, ids in enumerate(groups):
        for shard, ns in enumerate(mixing.shard_draws(0, shards, 10, g, shares, np.array([plan[s] for s in ids], dtype=float), 3).tolist()):
            for s, n in zip(ids, ns):
                n = min(n, plan[s] - used[s])
                used[s] += n
                want[shard, s] += n
    assert Counter((r.shard, r.sid) for r in got if r.shard < shards) == +want


def test_slots_are_never_broadcast(spark):
    df = spark.createDataFrame([(i, "w " * 200, "ab"[i % 2]) for i in range(50)], "doc_id long, text string, source string")
    _, taken = mixing.mix(df, block=4)
    taken.collect()
    plan = taken._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "MapInArrow" in plan and "SortMergeJoin" in plan and not any("block" in x for x in plan.splitlines() if "BroadcastHashJoin" in x)


def test_rows_with_equal_id_and_text_keep_their_source(spark):
    df = spark.createDataFrame([(None, "a b c d", "x"), (None, "a b c d", "y"), (7, "e f", "x"), (7, "e f", "y")], "doc_id long, text string, source string")
    out = mixing.mixed_documents(df, shards_col="shards").collect()
    words = Counter()
    for r in out:
        words[r.source] += len(r.text.split())
        assert r.shards == [0]
    assert words == {"x": 4, "y": 8} and {r.text for r in out if r.source == "x"} <= {"a b c d", "e f", "a b", "c d", "a b c", "a", "e"}


def mixing_brute(docs):
    size = [len(re.findall(f"[^{WS}]+", d[1] or "")) for d in docs]
    names = sorted({d[3] for d in docs if d[3] is not None}, key=lambda s: [ord(c) for c in s]) + [None]
    total = Counter()
    for d, n in zip(docs, size):
        total[d[3]] += n
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in capped)
        scale = left / sum(weight[s] for s in names if s not in capped)
        new = {s for s in names if s not in capped and scale * weight[s] > 3 * total[s]}
        if not new:
            return size, total, {s: 3 * total[s] if s in capped else scale * weight[s] for s in names}
        capped |= new


def test_mixing(spark, mini, docs):
    size, total, target = mixing_brute(docs)
    assert any(t == 3 * total[s] for s, t in target.items())
    got = REGISTRY["op4_mixing"](spark, mini).collect()
    want = Counter((d[0], n, total[d[3]], round(target[d[3]], 6)) for d, n in zip(docs, size))
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got) == want
    taken = Counter()
    source = {(d[0], n): d[3] for d, n in zip(docs, size)}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id, r.size]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)
    again = REGISTRY["op4_mixing"](spark, mini).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mixing_draws_in_many_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "SPAN_SHARDS", 1)
    docs = [(i, "w " * 180_000, "en", "abc"[i % 3]) for i in range(24)]  # two output shards, so two ranges
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = REGISTRY["op4_mixing"](spark, str(tmp_path)).collect()
    taken = Counter()
    for r in got:
        taken[docs[r.doc_id][3]] += r.taken
    assert len(got) == 24 and all(r.size == 180_000 and 0 <= r.taken <= 3 * r.size for r in got)
    assert taken == {"a": 720_000, "b": 1_440_000, "c": 2_160_000}


def test_mixed_documents_hold_the_taken_words(spark):
    r = random.Random(4)
    texts = ["\n ".join(f"w{i}_{j}" for j in range(r.randint(1, 90))) for i in range(50)] + ["", None]
    df = spark.createDataFrame([(i, t, "abc"[min(i % 7, 2)]) for i, t in enumerate(texts)], "doc_id long, text string, source string")
    placed, taken = mixing.mix(df, block=16)
    totals = {x._row: x.n for x in taken.groupBy("_row").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    want = {x._id: totals.get(x._row, 0) for x in placed.collect()}
    out = mixing.mixed_documents(df, block=16)
    assert out.dtypes == df.dtypes
    got = Counter()
    for x in out.collect():
        found = (x.text or "").split()
        assert set(found) <= set((texts[x.doc_id] or "").split()) and len(found) == len(set(found))
        got[x.doc_id] += len(found)
    assert {i: got[i] for i in range(52)} == want and {50, 51} <= set(got)


# packing

@given(st.lists(st.tuples(st.integers(0, 120), st.integers(0, 130)), max_size=40), st.integers(1, 50), st.integers(1, 6), st.integers(1, 50))
@settings(max_examples=150, deadline=None)
def test_packer_honours_every_limit(items, cap, segments, loss):
    p = packing.Packer(cap, segments, loss)
    got = []
    for a in range(0, len(items), 7):
        got += list(p.add([(i, n, prompt) for i, (n, prompt) in list(enumerate(items))[a:a + 7]]))
    got += list(p.finish())
    covered = defaultdict(list)
    for s in got:
        assert sum(n for _, _, n in s) <= cap and len(s) <= segments
        assert sum(n - max(0, min(n, items[k][1] - a)) for k, a, n in s) <= loss
        for k, a, n in s:
            covered[k].append((a, n))
    for k, (n, _) in enumerate(items):
        at = 0
        for a, m in sorted(covered[k]):
            assert a == at and m > 0
            at += m
        assert at == n


def test_packing(spark, mini, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    ids = [np.array([*e.ids, 1], dtype="<u4") for e in tokenizer.encode_batch([d[1] or "" for d in docs], add_special_tokens=False)]
    got = REGISTRY["op8_packing"](spark, mini).collect()
    want = Counter()
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    for d, x in zip(docs, ids):
        want[d[0], len(x)] += 1
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == want
    by_id = defaultdict(list)
    for d, x in zip(docs, ids):
        by_id[d[0]].append(x)
    for r in got:
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for x in by_id[r.doc_id])
    assert sum(r.length for r in got) == sum(map(len, ids))
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        end = 0
        for a, n in sorted(s):
            assert a == end
            end += n
        assert end <= 2048 and (end == 2048 or end & (end - 1) == 0)  # no padding at all


def test_sequences_full_of_segments_need_no_padding():
    p = packing.Packer()
    got = [*p.add([(i, 5, 0) for i in range(700)]), *p.finish()]
    sizes = [sum(n for _, _, n in s) for s in got]
    assert sum(sizes) == 3500 and all(n & (n - 1) == 0 for n in sizes) and max(map(len, got)) <= 256


def test_packing_of_prompts_and_answers(spark):
    prompts = [0, 3, 10, 50, None, -2] * 10
    rows = [(i, "the cat sees a dog " * (1 + i % 7), p) for i, p in enumerate(prompts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, prompt int").coalesce(1)
    got = packing.pack_documents(df, vocabulary(), max_tokens=64, max_loss=16, prompt_col="prompt").collect()
    seqs, total = defaultdict(list), Counter()
    for r in got:
        seqs[r.sequence_id].append((r.length, r.length - max(0, min(r.length, max(0, prompts[r.doc_id] or 0) - r.start))))
        total[r.doc_id, r.doc_tokens] += r.length
    assert len(total) == len(rows) and all(n == size for (_, size), n in total.items())
    assert all(sum(n for n, _ in s) <= 64 and sum(x for _, x in s) <= 16 for s in seqs.values())
    assert any(sum(n for n, _ in s) > 16 for s in seqs.values())  # tokens without loss do not count for it


def test_ids_of_capitals_with_combining_marks():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    pairs = ["H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a"]  # only the small letter has a composed form
    texts = [*pairs, *map(str.lower, pairs), "THE " + " ".join(f"Aa{p}B, {p}" for p in pairs) + " End", "E\u0301t\u00c9 \u0130I", "PLAIN Text"]
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.Encoder(vocabulary()).encode(texts)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_ids_of_any_text_are_the_vocabularys_own():
    from tokenizers import Tokenizer

    r, tokenizer, encoder = random.Random(9), Tokenizer.from_file(vocabulary()), packing.Encoder(vocabulary())
    signs = [*"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ  \t\n0123.,!?$%&*#'\"()-<|>éüßÉÜÀñçœŒĳİıŁſǅ\u0331\u030c\u0301\u0307ŉжЯ漢½²ﬁ\x1c\xa0\u3000\x85",
             "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "J\u030c", "H\u0331"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 14))) for _ in range(20_000)]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


# search

def test_search_matches_brute_force(spark, mini):
    from .conftest import make_embeddings

    v = [(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e, _ in make_embeddings()
         if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    want = []
    for n, (q, a) in enumerate(v):  # every row for itself, also those with a null or repeated id
        if q is not None and q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c is None, c or 0) for m, (c, b) in enumerate(v) if m != n)
            want += [(q, rank + 1, None if none else c, -s) for rank, (s, none, c) in enumerate(scored[:5])]
    assert Counter(map(tuple, REGISTRY["op6_topk_search"](spark, mini).collect())) == Counter(want)


def test_search_keeps_different_vectors_of_one_id(spark):
    queries = spark.createDataFrame([(0, [10], 0)], "id long, v array<long>, row long")
    candidates = spark.createDataFrame([(0, [10], 0), (0, [3], 1), (1, [5], 2), (1, [9], 3), (None, [9], 4)], "id long, v array<long>, row long")
    got = [tuple(r) for r in search.top_k(queries, candidates, 3).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 90), (0, 2, None, 90), (0, 3, 1, 50)]


@pytest.mark.parametrize("blocks", [(1, 1), (3, 7)])
def test_search_is_the_same_in_any_blocks(spark, monkeypatch, blocks):
    monkeypatch.setattr(search, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(search, "CANDIDATE_BLOCK", blocks[1])
    rows = [(i, [i % 3, i % 2, -(i % 5), 0][:1 + i % 4]) for i in range(23)]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    got = sorted(map(tuple, search.top_k(df.where("id < 4"), df.where("id < 20"), 4).collect()))
    want = []
    for q, a in rows[:4]:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in rows[:20] if c != q)
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:4])]
    assert got == sorted(want)


# quality

def test_quality_scores_every_row(spark, mini, docs):
    got = REGISTRY["op2_quality_classifier"](spark, mini).collect()
    assert Counter(r.doc_id for r in got) == Counter(d[0] for d in docs)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_quality_vote_matches_brute_force():
    r = np.random.default_rng(1)
    unit = lambda n: (x := r.normal(size=(n, 8))) / np.linalg.norm(x, axis=1, keepdims=True)
    model = {"vectors": unit(60), "labels": r.integers(0, 2, 60).astype(float)}
    docs = np.concatenate([unit(20), np.zeros((1, 8))])
    want = []
    for d in docs:
        near = sorted(((float(d @ v), y) for v, y in zip(model["vectors"], model["labels"])), reverse=True)[:25]
        w = [max(s, 0) ** quality.POWER for s, _ in near]
        want.append(sum(a * y for a, (_, y) in zip(w, near)) / sum(w) if sum(w) > 1e-12 else quality.PRIOR)
    assert np.allclose(quality.vote(docs, model), want)


def test_quality_learns_only_from_rows_not_held_out(spark):
    good = [f"the {a} walks to the {b} and sees it" for a in ("cat", "dog", "cow") for b in ("house", "tree", "lake", "road")]
    docs = [(i, good[i % 12] if i % 2 else " ".join(f"{w}%%%" for w in good[i % 12].split()), "s") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = lambda flip: spark.createDataFrame([(i, (i % 2) ^ (flip and zlib.crc32(str(i).encode()) % 5 == 0)) for i in range(300)], "doc_id long, quality int")
    a, b = (quality.quality_scores(df, quality.fit(df, labels(f))) for f in (False, True))
    got = {r.doc_id: r for r in a.collect()}
    assert {i: r.score for i, r in got.items()} == {r.doc_id: r.score for r in b.collect()}
    assert all(r.predicted == i % 2 for i, r in got.items())
    nothing = quality.fit(df, labels(False).where("quality = 5"))
    assert nothing is None and {r.score for r in quality.quality_scores(df, nothing).collect()} == {quality.PRIOR}


def test_quality_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    got = [(r.predicted, labels[r.doc_id]) for r in REGISTRY["op2_quality_classifier"](spark, path).collect() if r.held_out and r.doc_id in labels]
    for y in (0, 1):
        assert sum(p == y for p, t in got if t == y) >= 0.95 * sum(t == y for _, t in got)


# language

def test_language_of_pages(spark):
    docs = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog with this that", "en"), ("der hund und die katze mit dem nicht", "de")] * 20)]
    docs += [(None, None, "en"), (90, "", None)]
    model = language.fit_text_model(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    from .conftest import make_pages

    pages = make_pages()
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = language.identify(df, model).collect()
    assert Counter(r.page_id for r in got) == Counter(p[0] for p in pages)
    by = {r.page_id: r for r in got}
    assert all(by[i].lang == by[i].text_lang == by[i].declared == "en" for i in range(12))
    assert all(by[20 + i].lang == "de" and by[20 + i].declared == "de" for i in range(12)) and by[44].lang == "de"
    assert (by[40].text_lang, by[40].lang, by[40].host) == (None, "de", "de.example.org")  # the host decides
    assert by[43].host == "en.example.com" and by[43].lang == "en" and by[43].declared is None
    assert by[41].host == "" and by[41].suffix == "" and 0 < by[41].probability <= 1
    none = language.identify(df, None).collect()
    assert len(none) == len(pages) and {r.lang for r in none} == {None}


def test_languages_are_all_in_the_model(spark):
    r = random.Random(8)
    names = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(70)]
    vocab = {x: ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(8)] for x in names}
    text = lambda x: " ".join(r.choice(vocab[x]) for _ in range(40))
    docs = [(i, text(x), x) for i, x in enumerate(x for k, x in enumerate(names) for _ in range(3 if k < 64 else 2))]
    model = language.fit_text_model(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert model["languages"] == names
    pages = [(i, f"https://{x}.example/{j}", f'<html lang="{x}"><p>{text(x)}</p></html>') for i, (x, j) in enumerate((x, j) for x in names for j in range(2))]
    got = language.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()
    assert len(got) == len(pages) and all(p.lang == p.text_lang == p.declared for p in got)


def test_language_accuracy_without_declarations(spark):
    from pyspark.sql import functions as F

    path = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{path}/pages.parquet")
    truth = {r.page_id: r.l for r in pages.select("page_id", F.regexp_extract("html", 'lang="(..)"', 1).alias("l")).collect()}
    model = language.fit_text_model(spark.read.parquet(f"{path}/documents.parquet"))
    got = language.identify(pages.withColumn("html", F.regexp_replace("html", "<html[^>]*>", "<html>")), model).collect()
    assert all(r.declared is None for r in got)
    assert sum(truth[r.page_id] == r.lang for r in got) >= 0.97 * len(got)
    assert len(REGISTRY["op9_language_id"](spark, path).collect()) == len(truth)


def fusion_brute(rows, model):
    """Page by page: text, then host smoothed towards domain and all pages, declaration and suffix, each without the page's own share."""
    names, n = model["languages"], len(model["languages"])
    pages = []
    for _, url, html in rows:
        url, html = url or "", html or ""
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url)
        host = m[1].lower() if m else ""
        tag = re.search(r"(?i)<html\b([^>]*)", html)
        said = re.search(r"""(?i)(?:^|\s)lang\s*=\s*["']?\s*([a-z]{2,3})(?![a-z])""", tag[1] if tag else "")
        at, features = language.trigrams([language.visible_text(html)])
        ll = [sum(model["logp"][i][f] for f in features) * (min(len(at), language.EFFECTIVE) / max(1, len(at))) for i in range(n)]
        ll = [x - max(ll) for x in ll]
        z = sum(math.exp(x) for x in ll)
        domain = re.search(r"[^.]+\.[^.]+$", host)
        pages.append({"host": host, "domain": domain[0] if domain else "", "said": said[1].lower() if said else "", "suffix": host.rsplit(".", 1)[-1],
                      "ll": ll, "post": [math.exp(x) / z for x in ll], "letters": len(at) > 0})
    totals = [sum(p["post"][i] for p in pages) for i in range(n)]
    overall = [(t + 1) / (sum(totals) + n) for t in totals]
    out = []
    for p in pages:
        others = {k: [q for q in pages if q[k] == p[k] and q is not p] for k in ("host", "domain", "said", "suffix")}
        there = {k: [max(0.0, sum(q["post"][i] for q in v)) for i in range(n)] for k, v in others.items()}
        prior = overall
        for k in ("domain", "host"):
            prior = [(there[k][i] + language.KAPPA * prior[i]) / (len(others[k]) + language.KAPPA) for i in range(n)]
        score = [p["ll"][i] + math.log(prior[i]) for i in range(n)]
        for k in ("said", "suffix"):
            if p[k]:
                share = len(others[k]) / max(1.0, sum(totals) - 1)
                score = [s + math.log((1 - language.NOISE) * (there[k][i] + share) / (max(0.0, totals[i] - p["post"][i]) + 1) + language.NOISE * share + 1e-12)
                         for i, s in enumerate(score)]
        e = [math.exp(s - max(score)) for s in score]
        best = max(range(n), key=lambda i: e[i])
        out.append((p["host"], p["said"] or None, names[max(range(n), key=lambda i: p["ll"][i])] if p["letters"] else None, names[best], round(e[best] / sum(e), 6)))
    return out


@pytest.mark.parametrize("languages", [("en", "de"), ("en",)])
def test_fused_evidence_equals_brute_force(spark, languages):
    from .conftest import make_pages

    texts = {"en": "the cat and the dog with this that there", "de": "der hund und die katze mit dem nicht aber"}
    docs = [(None if i % 4 == 0 else i, texts[x] + f" {i}", x) for x in languages for i in range(12)]
    model = language.fit_text_model(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    rows = make_pages()
    df = spark.createDataFrame([(*r, 0.5, "x", [1.0]) for r in rows], "page_id long, url string, html string, probability double, host string, ll array<double>")
    got = language.identify(df, model).collect()
    assert Counter((r.host, r.declared, r.text_lang, r.lang, round(r.probability, 6)) for r in got) == Counter(fusion_brute(rows, model))
    assert {r.text_lang for r in got} == {*languages, None}


def test_quality_counts_a_batch_in_little_memory():
    import random
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from threadloom.llm import quality_knn
    r = random.Random(1)
    known = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(5000)]
    texts = [" ".join(r.choices(known, k=800)) for _ in range(2500)]
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(texts)), pa.array(texts)], ["label", "text"])
    tracemalloc.start()
    try:
        assert sum(x.num_rows for x in quality_knn._sparse([batch])) == len(texts)
        assert tracemalloc.get_traced_memory()[1] < 80e6
        tracemalloc.reset_peak()
        weights, basis = np.ones(quality_knn.FEATURES, np.float32), np.ones((quality_knn.FEATURES, 4), np.float32)
        assert len(quality_knn._project(batch.column(1)[:800], weights, basis)) == 800
        assert tracemalloc.get_traced_memory()[1] < 80e6
    finally:
        tracemalloc.stop()
