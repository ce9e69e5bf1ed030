"""Reply chains against a sequential walk, and the as-of scan they stand on."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import reply_chains as R
from threadloom.operators.ranking import hot_key_join, scan_last, with_bucket


def words(text):
    return " ".join((text or "").replace("\u00a0", " ").split())


def walk(posts, pairs):
    """The latest earlier post whose words hold the quote's; then up from post to post."""
    by_topic = {}
    for t, pos, _, text in posts:
        by_topic.setdefault(t, []).append((pos, f" {words(text)} "))
    links, parent = [], {}
    for t, pos, k, quote, reply in sorted(pairs, key=lambda x: (str(x[0]), x[1], x[2])):
        held = [p for p, text in by_topic.get(t, []) if p < pos and words(quote) and f" {words(quote)} " in text]
        if held:
            links.append((t, pos, k, max(held)))
            parent.setdefault((t, pos), (max(held), reply))
    rows = set()
    for t, pos in parent:
        at, depth = pos, 0
        while (t, at) in parent:
            at, depth = parent[t, at][0], depth + 1
        rows |= {(t, at, depth, pos, parent[t, pos][0], parent[t, pos][1]), (t, at, 0, at, None, None)}
    return links, rows


def make(seed, n):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["да", "x.y", "a%b"]
    posts, pairs = [], []
    for i in range(n):
        t = r.choice(["hot", "hot", f"t{r.randrange(12)}", None])  # a topic with half of the posts, and one without an id
        mine = [p for p in posts if p[0] == t]
        text = r.choice([None, "", " \t", "same words in many posts", " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 14)))])
        if mine and r.random() < 0.2:
            text = r.choice(mine)[3]
        posts.append((t, i, f"u{i % 5}", text))
        for k in range(r.choice([0, 0, 1, 1, 2])):
            cited = words(r.choice(mine)[3] if mine else "no such post").split()
            a = r.randrange(len(cited)) if cited else 0
            quote = r.choice([" ", "  "]).join(cited[a:a + r.choice([1, 2, 4, 5, 20])])
            pairs.append((t, i, k, quote if r.random() < 0.9 else quote + " not there", f"reply {i} {k}"))
    return posts, pairs


@pytest.mark.parametrize("seed,bucket", [(1, 7), (2, 1 << 16)])
def test_chains_equal_a_sequential_walk(spark, seed, bucket):
    posts, pairs = make(seed, 400)
    p = spark.createDataFrame(posts, "topic_id string, pos long, author_id string, text string").withColumn("source", F.lit("s"))
    q = spark.createDataFrame(pairs, "topic_id string, pos long, k long, speaker0_text string, speaker1_text string").withColumn("source", F.lit("s"))
    known = [(t, pos, a, x) for t, pos, a, x in posts if t is not None]  # a post without a topic cites nothing
    links, rows = walk(known, [x for x in pairs if x[0] is not None])
    got = R.reply_links(p, q, bucket_size=bucket).collect()
    assert sorted((x.topic_id, x.pos, x.k, x.cited_pos) for x in got) == sorted(links) and len(links) > 50
    out = R.quote_chains(p, q, bucket_size=bucket).collect()
    assert sorted((x.topic_id, x.root_pos, x.depth, x.pos, x.cited_pos, x.text) for x in out if x.depth) == sorted(x for x in rows if x[2])
    assert sorted((x.topic_id, x.root_pos) for x in out if not x.depth) == sorted((x[0], x[1]) for x in rows if not x[2])
    assert max(x[2] for x in rows) > 1


def test_a_long_chain_takes_few_rounds(spark):
    n = 3000
    links = spark.range(1, n).select(F.lit("s").alias("source"), F.lit("t").alias("topic_id"), F.col("id").alias("pos"), (F.col("id") - 1).alias("parent"))
    out = R.chain_roots(links, max_rounds=13).agg(F.count("*"), F.max("depth"), F.max("root_pos"), F.sum(F.col("pos") - F.col("depth"))).first()
    assert tuple(out) == (n - 1, n - 1, 0, 0)
    with pytest.raises(RuntimeError):
        R.chain_roots(links, max_rounds=5)


def test_no_quotes_no_chains(spark):
    p = spark.createDataFrame([("s", "t", 0, "u", "text")], "source string, topic_id string, pos long, author_id string, text string")
    q = spark.createDataFrame([], "source string, topic_id string, pos long, k long, speaker0_text string, speaker1_text string")
    assert R.quote_chains(p, q).collect() == []


def test_scan_last_over_buckets(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None]), i, r.choice([None, None, i])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, pos long, v long")
    got = {(x.k, x.pos): x.out for x in scan_last(with_bucket(df, "pos", 16), ["k"], ["pos"], "v", "out").collect()}
    last, want = {}, {}
    for k, pos, v in rows:
        last[k] = v if v is not None else last.get(k)
        want[k, pos] = last[k]
    assert got == want


def test_hot_key_join_takes_nulls_as_equal(spark):
    rows = spark.createDataFrame([("a", i) for i in range(50)] + [(None, 60), ("b", 61), ("z", 62)], "k string, i long")
    per_key = spark.createDataFrame([("a", 50, "A"), (None, 1, "N"), ("b", 1, "B")], "k string, w long, v string")
    got = {(x.k, x.i): x.v for x in hot_key_join(rows, per_key, ["k"], "w", "left").collect()}
    assert got == {**{("a", i): "A" for i in range(50)}, (None, 60): "N", ("b", 61): "B", ("z", 62): None}


def test_quotes_are_looked_up_by_pairs_of_hashes(spark, monkeypatch):
    r = random.Random(7)
    line = lambda n: " ".join(f"w{r.randrange(30)}" for _ in range(n))
    texts = [(r.choice(["hot", "hot", "a", "b", None]), i, line(r.randint(1, 90))) for i in range(150)]
    texts += [(t, i + 1000, x) for t, i, x in texts[:20]]  # copies
    quotes = set()
    for t, _, x in texts:
        w, n = x.split(), r.choice([1, 2, 3, 5, 8, 11, 12, 30, 90])
        a = r.randrange(len(w))
        quotes |= {(t, " ".join(w[a:a + n])), (t, " ".join(w[a:a + n]) + " w31")}
    want = sorted((t, q, i) for t, q in quotes for u, i, x in texts if t is not None and t == u and f" {q} " in f" {x} ")
    stages, kept = {}, R.materialize
    monkeypatch.setattr(R, "materialize", lambda df, name: stages.setdefault(name, kept(df, name)))
    q = spark.createDataFrame(sorted(quotes, key=str), "topic_id string, quote string").withColumn("source", F.lit("s"))
    p = spark.createDataFrame(texts, "topic_id string, pos long, text string").withColumn("source", F.lit("s"))
    assert sorted((x.topic_id, x.quote, x.pos) for x in R.cited_texts(q, p).collect()) == want and len(want) > 200
    # no text rides along with its fragments
    assert {t for name in ("quote_fragments", "found_fragments") for _, t in stages[name].dtypes} == {"bigint"}
    # a topic of long quotes takes a part of its texts' fragments
    stages.clear()
    long = [(f"t{i}", line(400)) for i in range(20)]
    p = spark.createDataFrame([(t, 0, x) for t, x in long], "topic_id string, pos long, text string").withColumn("source", F.lit("s"))
    q = spark.createDataFrame(long, "topic_id string, quote string").withColumn("source", F.lit("s"))
    assert R.cited_texts(q, p).count() == 20 and stages["found_fragments"].count() < 20 * 200
