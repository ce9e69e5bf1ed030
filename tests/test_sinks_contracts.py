from pyspark.sql import functions as F

from threadloom.operators import contracts
from threadloom.session import job_dir
from threadloom.sources import sinks


def test_blocked_pages_needs_status_host_and_marker(spark):
    m = contracts.BLOCK_MARKER
    log = spark.createDataFrame([
        ("https://www.b17.ru/forum/topic.php?id=1", 503, f"<p>{m}</p>"),
        ("https://www.b17.ru/forum/topic.php?id=2", 503, "<p>busy</p>"),
        ("https://other.example/x", 503, f"<p>{m}</p>"),
        ("https://www.b17.ru/forum/topic.php?id=3", 200, f"<p>{m}</p>"),
    ], "url string, status int, body string")
    assert [r.url for r in contracts.blocked_pages(log).collect()] == ["https://www.b17.ru/forum/topic.php?id=1"]


def test_contract_rows_lower_bounds(spark):
    posts = spark.createDataFrame([("psy_su", "u1")] * 20 + [("psy_su", "u2")] * 3 + [("psyhelp24_org", "u3")],
                                  "source string, url string")
    got = {r.url: (r.n_rows, r.ok) for r in contracts.contract_rows(posts).collect()}
    assert got == {"u1": (20, True), "u2": (3, False), "u3": (1, True)}


def test_exports_allow_list_and_multiline(spark):
    rows = [("a1", "Ann", 'line "one"\nline, two', "7", None, "https://psy.su/x", "<p>x</p>", 0, "psy_su"),
            ("b1", "Bob", "plain", "8", None, "https://b", "<p>y</p>", 1, "documents")]
    posts = spark.createDataFrame(rows, "author_id string, author_name string, text string, topic_id string, "
                                        "topic_name string, url string, html string, pos long, source string")
    folder = job_dir(spark, "test_exports")
    names = F.when(F.col("source") == "psy_su", F.lit("data_psy_su.csv")).otherwise(F.lit("data_other.csv"))
    sinks.write_post_exports(posts, folder, lambda c: names)
    back = sinks.read_post_exports(spark, folder).collect()
    assert len(back) == 1 and back[0].text == 'line "one"\nline, two' and back[0].pos == "0"
    assert back[0].export == "data_psy_su.csv"


def test_dataset_csv_roundtrip_keeps_quotes_and_newlines(spark):
    lines = spark.createDataFrame([(0, '|0|1|say "hi",\nok|1|1|x'), (1, "|0|1|a|1|1|b")], "k long, line string")
    path = job_dir(spark, "test_dataset")
    sinks.write_dataset(lines, path, ["k"])
    assert sorted(r.line for r in sinks.read_dataset(spark, path).collect()) == sorted(
        r.line for r in lines.collect())


def test_block_cache_follows_its_input(spark):
    root = job_dir(spark, "test_cache")
    src = f"{root}/src"
    spark.range(3).write.parquet(src)
    first = sinks.file_fingerprint(spark.read.parquet(src))
    assert first == sinks.file_fingerprint(spark.read.parquet(src))
    built = []

    def build():
        built.append(1)
        return spark.range(5)
    for _ in range(2):
        assert sinks.cached_blocks(spark, root, 8, first, build).count() == 5
    assert len(built) == 1
    spark.range(4).write.mode("overwrite").parquet(src)
    assert sinks.file_fingerprint(spark.read.parquet(src)) != first
    # a half-written cache has no marker and is built again
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/blocks_8_half")
    assert sinks.cached_blocks(spark, root, 8, "half", build).count() == 5
