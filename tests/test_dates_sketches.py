"""Sessions, as-of answers, sketches, the map-only split and rolled-up yields against brute force."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from threadloom.operators import sampling, sessions, stats

SCHEMA = "topic string, post_id long, ts timestamp, asks boolean"


def make(seed):
    r = random.Random(seed)
    base = datetime(2024, 3, 1)
    rows = []
    for i in range(400):  # a topic with half of the posts, one without an id, ties in time, posts without a time
        topic = r.choice(["hot", "hot", "a", "b", None])
        ts = None if r.random() < 0.03 else base + timedelta(seconds=r.choice([r.randrange(300_000), 600 * r.randrange(500)]))
        rows.append((topic, i, ts, r.choice([True, False, False, None])))
    return rows


@pytest.mark.parametrize("gap", [60, 600, 7200])
def test_sessions(spark, gap):
    rows, want = make(gap), []
    times = defaultdict(list)
    for topic, _, ts, _ in rows:
        if ts is not None:
            times[topic].append(ts)
    for topic, ts in times.items():
        groups = []
        for t in sorted(ts):
            if groups and (t - groups[-1][-1]).total_seconds() <= gap:
                groups[-1].append(t)
            else:
                groups.append([t])
        want += [(topic, i, g[0], g[-1], len(g)) for i, g in enumerate(groups)]
    got = sessions.topic_sessions(spark.createDataFrame(rows, SCHEMA), ["topic"], gap_seconds=gap).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("within,bucket", [(None, 3600), (5000, 86_400)])
def test_answers_as_of(spark, within, bucket):
    rows, want = make(9), []
    for topic, i, ts, asks in rows:
        if ts is None or asks:
            continue
        asked = [(t, j) for k, j, t, a in rows if k == topic and a and t is not None and (t, j) < (ts, i)]
        t, j = max(asked, default=(None, None))
        waited = None if t is None else (ts - t).total_seconds()
        if waited is not None and within is not None and waited > within:
            j = waited = None
        want.append((topic, i, j, waited))
    got = sessions.answers_as_of(spark.createDataFrame(rows, SCHEMA), ["topic"], F.col("asks"), within_seconds=within, bucket_seconds=bucket)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_sketches_merge_without_the_old_posts(spark):
    posts = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), (F.col("id") % 20_011).alias("topic_id"))
    old, new = posts.where("topic_id < 15000"), posts.where("topic_id >= 14000")
    merged = stats.sketched_topic_count(stats.merge_sketches(stats.topic_sketches(old), stats.topic_sketches(new)))
    whole = {x.source: x.n_topics for x in stats.sketched_topic_count(stats.topic_sketches(posts)).collect()}
    exact = {x.source: x.n_topics for x in stats.topic_count(posts).collect()}
    assert {x.source: x.n_topics for x in merged.collect()} == whole
    assert all(abs(whole[s] - n) <= 0.03 * n for s, n in exact.items())


def test_threshold_split_moves_no_line(spark):
    lines = spark.range(5000).select("id", F.lit("x" * 50).alias("line"))
    out = sampling.split_threshold(lines, ["id"], 0.8, digits=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    got = {x.id: x.split for x in out.collect()}
    n = Counter(got.values())["train"]
    assert 4000 <= n < 4000 + 12  # less than one bin of about 5000 / 16^3 rows more
    wider = {x.id: x.split for x in sampling.split_threshold(lines, ["id"], 0.9, digits=3).collect()}
    assert all(wider[i] == "train" for i, s in got.items() if s == "train")
    assert {x.split for x in sampling.split_threshold(lines, ["id"], 0.0).collect()} == {"test"}
    assert {x.split for x in sampling.split_threshold(lines, ["id"], 1.0).collect()} == {"train"}
    assert sampling.split_threshold(lines.limit(0), ["id"]).collect() == []


def test_yield_rollup(spark):
    rows = [("s", "1", "chain", "ab"), ("s", "1", "quote", "c"), ("s", None, "quote", "ddd"), (None, "1", "chain", "e")]
    got = stats.yield_rollup(spark.createDataFrame(rows, "source string, len1 string, kind string, line string")).collect()
    assert Counter(map(tuple, got)) == Counter([
        *[(a, b, c, 0, 1, len(x)) for a, b, c, x in rows], ("s", "1", None, 1, 2, 3), ("s", None, None, 1, 1, 3), (None, "1", None, 1, 1, 1),
        ("s", None, None, 3, 3, 6), (None, None, None, 3, 1, 1), (None, None, None, 7, 4, 7)])
