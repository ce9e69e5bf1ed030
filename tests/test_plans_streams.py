import __spark_entry__ as E
from threadloom.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 90


def test_flagship_plan_shape(spark):
    plan = _plan(REGISTRY["dialog_dataset"](spark, SF))
    assert "SinglePartition" not in plan          # no single-task window / sort
    assert "WindowGroupLimit" in plan             # partial top-5 before the shuffle
    assert "BatchEvalPython" not in plan          # no row-at-a-time Python UDF


def test_chain_windows_are_bucketed(spark):
    from threadloom.operators import chains
    from threadloom.plans.queries import doc_posts
    plan = _plan(chains.chain_segments(chains.flag_posts(doc_posts(spark, SF))))
    import re
    windows = [ln for ln in plan.split("\n") if "Window [" in ln and re.search(r"pos#\d+L ASC", ln)]
    assert windows and all("_bk" in ln for ln in windows)   # (topic, bucket) partitions only


def test_stream_prompts_equal_batch(spark):
    batch = {(r.conv_id, r.turn): r.prompt for r in REGISTRY["prompt_last5"](spark, SF).collect()}
    stream = {(r.conv_id, r.turn): r.prompt for r in REGISTRY["stream_prompts"](spark, SF).collect()}
    assert stream == batch


def test_stream_ingest_exactly_once(spark):
    a = REGISTRY["stream_ingest"](spark, SF)
    b = REGISTRY["scan_posts"](spark, SF)
    assert a.count() == b.count() == a.select("source", "topic_id", "pos").distinct().count()


class _State:
    """A value, list or map state in memory that counts the round trips it stands for."""

    def __init__(self):
        self.v, self.calls = None, 0

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            if name in ("update", "put"):
                self.v = args[0]
            elif name == "appendList":
                self.v = [*(self.v or []), *args[0]]
            elif name == "clear":
                self.v = None
            elif name == "updateValue":
                self.v = {**(self.v or {}), args[0]: args[1]}
            elif name == "removeKey":
                del self.v[args[0]]
            elif name == "exists":
                return bool(self.v)
            elif name == "iterator":
                return iter(self.v.items())
            else:
                return self.v
        return call


def test_prompt_state_costs_few_round_trips():
    import random

    import pandas as pd

    from threadloom.streaming.jobs import PromptProcessor
    states = []

    class Handle:
        def made(self, *args):
            states.append(_State())
            return states[-1]
        getValueState = getListState = getMapState = made

    r = random.Random(3)
    for batches in (1, 2, 9):
        states.clear()
        p = PromptProcessor(3, "-")
        p.init(Handle())
        said = [(t, r.choice([0, 1, None]), f"<{t}>") for t in range(40)]
        order, got = r.sample(said, 40) if batches > 1 else said, {}
        for i in range(batches):
            for out in p.handleInputRows((7,), iter([pd.DataFrame(order[i::batches], columns=["turn", "speaker", "piece"])]), None):
                got |= dict(zip(out["turn"].tolist(), out["prompt"].tolist()))
        pieces = [x for x in said if x[1] is not None]
        assert got == {t: "".join(x[2] for x in pieces[:i + 1][-3:]) + "|1|-|" for i, (t, s, _) in enumerate(pieces) if s == 0}
        assert states[0].calls == 2 * batches and states[1].calls <= batches + 2 * 40 and (batches > 1 or not states[1].calls)


def test_stream_inputs_have_a_bounded_number_of_files(spark, monkeypatch):
    from pathlib import Path

    from threadloom.plans import queries as Q
    seen = {}

    def count(name):
        def run(spark, folder, schema, *args, **options):
            seen[name] = len([f for f in Path(folder.removesuffix("/*").removeprefix("file:")).rglob("*.parquet")])
            return spark.createDataFrame([], schema)
        return run
    pages = Q.forum_pages(spark, SF)
    monkeypatch.setattr(Q, "forum_pages", lambda spark, sf: pages.repartition(40))
    monkeypatch.setattr(Q, "POST_OUT", pages.columns)
    monkeypatch.setattr(Q.jobs, "stream_extract", count("extract"))
    monkeypatch.setattr(Q.jobs, "stream_prompts", count("prompts"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        Q.q_stream_extract(spark, SF)
        Q.q_stream_prompts(spark, SF)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert seen["extract"] == Q.HARVEST_FILES and seen["prompts"] < 16 + Q.HARVEST_FILES
