"""Seen urls across runs, re-crawled posts and late turns on a stream."""

import random
from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from threadloom.operators import encode, links
from threadloom.session import job_dir
from threadloom.sources.seen_urls import SeenUrls
from threadloom.streaming import jobs


def test_a_url_is_new_once_over_many_runs(spark):
    r = random.Random(3)
    seen = SeenUrls(spark, job_dir(spark, "seen"), buckets=4, fanout=2)
    met, handed = set(), []
    for run in range(6):
        urls = [r.choice([None, f"u{r.randrange(40)}"]) for _ in range(25)]
        df = spark.createDataFrame([(u,) for u in urls], "url string")
        new = sorted(x.url for x in seen.unseen(df).collect())
        assert new == sorted({*urls} - met - {None})
        seen.extend(df)
        met |= {*urls} - {None}
        handed += new
    assert len(handed) == len(set(handed)) and sorted(x.url for x in seen.urls().collect()) == sorted(met)
    assert len(seen.generations()) < 6  # merged on the way
    again = SeenUrls(spark, seen.path, buckets=4, fanout=2)  # as a later session finds it
    assert again.unseen(spark.createDataFrame([(u,) for u in met], "url string")).count() == 0


def test_old_urls_are_not_shuffled(spark):
    seen = SeenUrls(spark, job_dir(spark, "seen"), buckets=4)
    for part in ("a", "b"):
        seen.extend(spark.range(50).select(F.concat(F.lit(part), F.col("id").cast("string")).alias("url")))
    out = seen.unseen(spark.range(80).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("url")))
    assert out.count() == 30
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange") == 1  # the run's own urls
    assert plan.count("Bucketed: true") == 2


def test_a_run_that_broke_off_counts_for_nothing(spark):
    from threadloom.session import file_system
    seen = SeenUrls(spark, job_dir(spark, "seen"), buckets=2)
    first, second = (spark.createDataFrame([(u,)], "url string") for u in "ab")
    seen.extend(first)
    seen.extend(second)
    fs, marker = file_system(spark, f"{seen.path}/gen-0-1/_SUCCESS")
    fs.delete(marker, False)
    assert [x.url for x in seen.unseen(second).collect()] == ["b"]
    seen.extend(second)
    assert sorted(x.url for x in seen.urls().collect()) == ["a", "b"]


def test_three_runs_hand_out_what_one_does(spark):
    page = lambda i, *to: (i, f"http://h.example/{i}", "".join(f'<a href="/{t}#x">l</a>' for t in to))
    rows = [page(0, 1, 7, 8), page(1, 0, 7, 9), page(2, 10, 1, "a&amp;b"), page(3, 11, 7, 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    hosts = spark.createDataFrame([("h.example",)], "host string")
    one = {x.url for x in links.frontier(links.resolved_links(pages), pages, hosts).collect()}
    seen, runs = SeenUrls(spark, job_dir(spark, "seen"), buckets=2), []
    for ids in ((0, 1), (2,), (3,)):
        mine = pages.where(F.col("page_id").isin(*ids))
        runs.append({x.url for x in links.frontier_run(seen, links.resolved_links(mine), mine, hosts).collect()})
    assert not runs[0] & runs[1] and not runs[1] & runs[2] and not runs[0] & runs[2]
    fetched = {r[1] for r in rows}
    assert runs[0] | runs[1] | runs[2] | fetched == one | fetched


POSTS = "url string, text string, harvested_at timestamp, who string"


def test_recrawled_posts_pass_once_after_a_stop(spark):
    base = job_dir(spark, "recrawl")
    at = lambda day: datetime(2024, 1, 1 + day)
    crawls = [[("u1", "a", at(0), "x"), ("u1", "b", at(0), "x"), (None, "a", at(0), "x"), ("u1", "a", at(0), "y")],
              [("u1", "a", at(1), "x"), ("u1", None, at(1), "x"), ("u2", "a", at(1), "x")],
              [("u1", "b", at(2), "z"), (None, "a", at(2), "x"), ("u1", None, at(2), "x"), ("u1", "a!", at(2), "x")]]
    for i, rows in enumerate(crawls):
        spark.createDataFrame(rows, POSTS).coalesce(1).write.parquet(f"{base}/in/c{i}")
        out = jobs.stream_dedup(spark, f"{base}/in/*", POSTS, f"{base}/out", f"{base}/ckpt")  # stops when all is in, resumes with the next crawl
        batch = {(u, t) for rows in crawls[:i + 1] for u, t, *_ in rows}
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(batch, key=repr)


def _turns(spark, base, batches):
    from threadloom.sources import sinks
    rows = [(c, t, role, text, i) for i, batch in enumerate(batches) for c, t, role, text in batch]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, arrived int")
    df.repartition(1).write.partitionBy("arrived").parquet(f"{base}/in")
    sinks.set_arrival_times(spark, f"{base}/in", "arrived")
    return "conv_id long, turn long, role string, text string", df


def test_prompts_of_turns_in_any_order(spark):
    r = random.Random(8)
    turns = [(c, t, r.choice(["user", "assistant", "system"]), r.choice([None, "", f"text {c} {t}"])) for c in range(4) for t in range(r.randint(1, 9))]
    shuffled = r.sample(turns, len(turns))
    base = job_dir(spark, "late")
    schema, df = _turns(spark, base, [shuffled[i::4] for i in range(4)] + [shuffled[:5]])  # the last batch repeats turns
    got = jobs.stream_prompts(spark, f"{base}/in/*", schema, f"{base}/out", f"{base}/ckpt", history=3)
    want = encode.prompts(encode.chat_turns(spark.createDataFrame(turns, schema)), history=3)
    key = lambda d: sorted((x.conv_id, x.turn, x.prompt) for x in d.collect())
    assert key(got) == key(want)


class _State:
    """The state a processor asks its handle for, kept in plain values."""

    def __init__(self):
        self.lists, self.map, self.value, self.timers = [], {}, None, []

    def getListState(self, *_): return self
    def getMapState(self, *_): return self._Map(self)
    def getValueState(self, *_): return self._Value(self)
    def exists(self): return bool(self.lists)
    def get(self): return iter(self.lists)
    def put(self, rows): self.lists = rows
    def listTimers(self): return iter(self.timers)
    def deleteTimer(self, t): self.timers.remove(t)
    def registerTimer(self, t): self.timers.append(t)

    class _Map:
        def __init__(self, s): self.s = s
        def exists(self): return bool(self.s.map)
        def iterator(self): return iter(list(self.s.map.items()))
        def removeKey(self, k): del self.s.map[k]
        def updateValue(self, k, v): self.s.map[k] = v

    class _Value:
        def __init__(self, s): self.s = s
        def exists(self): return self.s.value is not None
        def get(self): return self.s.value
        def update(self, v): self.s.value = v

    def getCurrentProcessingTimeInMs(self): return 1000


def test_a_missing_turn_is_waited_for_no_longer_than_patience():
    state, p = _State(), jobs.PromptProcessor(2, "-", patience_ms=50)
    p.init(state)
    rows = lambda *turns: iter([pd.DataFrame({"turn": list(turns), "speaker": [0] * len(turns), "piece": [f"|0|1|t{t}" for t in turns]})])
    said = lambda frames: [x for f in frames for x in f["prompt"].tolist()]
    assert said(p.handleInputRows((7,), rows(0, 2, 3), state)) == ["|0|1|t0|1|-|"]
    assert sorted(state.map) == [(2,), (3,)] and state.timers == [1050]
    assert said(p.handleExpiredTimer((7,), state, None)) == ["|0|1|t0|0|1|t2|1|-|", "|0|1|t2|0|1|t3|1|-|"]
    assert not state.map and said(p.handleInputRows((7,), rows(1, 4, 3), state)) == ["|0|1|t3|0|1|t4|1|-|"]  # 1 is too late, 3 a repetition
    assert not state.timers


def test_full_prompts_over_buckets(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], f"t{t}") for c in (1, 2) for t in range(23)]
    turns = encode.chat_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    small = {(x.conv_id, x.turn): x.prompt for x in encode.prompts(turns, history=None, full_bucket=4).collect()}
    assert small[2, 4] == "|0|1|t0|1|1|t1|0|1|t2|1|1|t3|0|1|t4|1|-|"
    assert small == {(x.conv_id, x.turn): x.prompt for x in encode.prompts(turns, history=None).collect()} and len(small) == 24
