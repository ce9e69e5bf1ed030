import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from threadloom.operators import packing, sampling
from threadloom.operators.ranking import global_offsets, scan_first, scan_transitions, with_bucket


def test_global_offsets_matches_running_sum(spark):
    rng = random.Random(3)
    rows = [(f"k{rng.randint(0, 5)}", i, rng.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, i long, n long")
    got = {(r.g, r.i): r.offset for r in global_offsets(df, ["g", "i"], size_col="n", num_partitions=7).collect()}
    acc, exp = 0, {}
    for g, i, n in sorted(rows):
        exp[(g, i)] = acc
        acc += n
    assert got == exp
    ranks = sorted(r.offset for r in global_offsets(df, ["g", "i"], num_partitions=5).collect())
    assert ranks == list(range(300))


def test_scan_transitions_equals_window(spark):
    rng = random.Random(5)
    rows = [(f"t{rng.randint(0, 3)}", i, rng.random() < 0.5) for i in range(200)]
    df = spark.createDataFrame(rows, "t string, pos long, v boolean")
    for size in (1, 3, 50, 1 << 20):
        d = with_bucket(df, "pos", size)
        got = {r.pos: r.cnt for r in scan_transitions(d, ["t"], "pos", "v", lambda p, c: c & ~p, "cnt").collect()}
        w = Window.partitionBy("t").orderBy("pos")
        st = F.coalesce(F.col("v") & ~F.lag("v").over(w), F.lit(False)).cast("long")
        exp = {r.pos: r.cnt for r in df.withColumn("st", st)
               .withColumn("cnt", F.sum("st").over(w.rowsBetween(Window.unboundedPreceding, 0))).collect()}
        assert got == exp, size


def test_split_exact_disjoint_complete(spark):
    df = spark.createDataFrame([(i, f"l{i}") for i in range(10)], "id long, line string")
    s = sampling.split(df, ["id"]).collect()
    train = {r.id for r in s if r.split == "train"}
    test = {r.id for r in s if r.split == "test"}
    assert len(train) == 8 and len(test) == 2 and not (train & test) and train | test == set(range(10))
    ranks = sorted(r.shuffle_rank for r in sampling.shuffle(df, ["id"]).collect())
    assert ranks == list(range(10))
    assert sampling.cap_sample(df, ["id"], n=3).count() == 3


def test_split_takes_every_row(spark):
    n = 300_050  # more than the sample size the notebooks use
    s = sampling.split(spark.range(n).withColumnRenamed("id", "k"), ["k"])
    counts = {r.split: (r.c, r.d) for r in s.groupBy("split").agg(F.count(F.lit(1)).alias("c"), F.countDistinct("k").alias("d")).collect()}
    assert counts == {"train": (240_040, 240_040), "test": (60_010, 60_010)}


def test_split_of_a_sample(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    s = sampling.split(sampling.cap_sample(df, ["k"], n=300).drop("shuffle_rank"), ["k"])
    assert {r.split: r["count"] for r in s.groupBy("split").count().collect()} == {"train": 240, "test": 60}


def test_global_offsets_keep_null_and_equal_keys(spark):
    rows = [(None, 3, "a"), ("x", 1, "b"), (None, 2, "c"), ("x", 1, "d"), ("y", None, "e")]
    df = spark.createDataFrame(rows, "k string, size long, payload string")
    got = global_offsets(df, ["k"], num_partitions=3).collect()
    assert sorted(r.offset for r in got) == [0, 1, 2, 3, 4] and {r.payload for r in got} == set("abcde")
    assert {r.payload for r in got if r.offset < 2} == {"a", "c"}  # nulls first
    sized = {r.payload: r.offset for r in global_offsets(df, ["k"], size_col="size", num_partitions=3).collect()}
    assert {sized["a"], sized["c"]} in ({0, 3}, {0, 2}) and {sized["b"], sized["d"]} == {5, 6} and sized["e"] == 7


def test_scans_keep_null_keys(spark):
    from threadloom.operators.ranking import scan_rank
    rows = [(None, p, p % 2 == 0) for p in range(6)] + [("t", 9, True)]
    df = spark.createDataFrame(rows, "t string, pos long, v boolean")
    d = with_bucket(df, "pos", 2)
    assert scan_first(d, ["t"], "pos", "v", "f").count() == 7
    ranks = {(r.t, r.pos): r.n for r in scan_rank(d, ["t"], ["pos"], "n").collect()}
    assert ranks == {**{(None, p): p for p in range(6)}, ("t", 9): 0}
    steps = {r.pos: r.c for r in scan_transitions(d, ["t"], "pos", "v", lambda p, c: c & ~p, "c").filter("t is null").collect()}
    assert steps == {0: 0, 1: 0, 2: 1, 3: 1, 4: 2, 5: 2}


def test_blocks_drop_partial(spark):
    # 9 pre-tokens + the newline token = 10 tokens; size 4 -> 2 blocks, 2 dropped
    df = spark.createDataFrame([(0, "a b c d e f g h i")], "k long, line string")
    blocks = packing.pack_blocks(df, ["k"], size=4).orderBy("block_id").collect()
    assert [b.n_tokens for b in blocks] == [4, 4]
    assert blocks[0].block_text == "a b c d" and blocks[1].block_text == " e f g h"
    assert packing.pad_batches(packing.pack_blocks(df, ["k"], size=4)).filter("n_pad > 0").count() == 0
    whole = packing.pack_blocks(df, ["k"], size=4, keep_last=True).orderBy("block_id").collect()
    assert [b.n_tokens for b in whole] == [4, 4, 2] and "".join(b.block_text for b in whole) == "a b c d e f g h i\n"
    padded = {r.block_id: (r.n_pad, r.padded_text) for r in packing.pad_batches(packing.pack_blocks(df, ["k"], size=4, keep_last=True)).collect()}
    assert padded[2] == (2, " i\n<pad><pad>")


def test_prompts_halo_buckets_equal_plain_window(spark):
    from threadloom.operators import encode
    rows = [(c, t, ["user", "assistant", "system"][(c + t) % 3], f"t{c}-{t}") for c in range(4) for t in range(23)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = encode.chat_turns(conv)
    exp = {(r.conv_id, r.turn): r.prompt for r in encode.prompts(turns, history=5, bucket_size=1 << 16).collect()}
    for bs in (5, 6, 7):
        got = {(r.conv_id, r.turn): r.prompt for r in encode.prompts(turns, history=5, bucket_size=bs).collect()}
        assert got == exp, bs
    w5 = [p for (c, t), p in sorted(exp.items()) if c == 0][-1]
    assert w5.count("|t0-") == 5


def test_scan_rank_buckets(spark):
    from threadloom.operators.ranking import scan_rank, with_bucket
    rows = [(k, p, r) for k in range(3) for p in range(7) for r in range(3)]
    df = spark.createDataFrame(rows, "k long, p long, r long")
    for bs in (1, 2, 100):
        got = {(x.k, x.p, x.r): x.rank for x in scan_rank(with_bucket(df, "p", bs), ["k"], ["p", "r"], "rank").collect()}
        assert got == {(k, p, r): p * 3 + r for k, p, r in rows}
