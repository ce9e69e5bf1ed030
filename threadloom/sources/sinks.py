"""Sinks and re-reads (S4-S8): parquet / CSV / text writers and a block cache.

Writers take an explicit path; the registered queries write under the
session's checkpoint folder and read the result back, so a query's output
is what a later job would read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.session import file_fingerprint, file_system, is_finished  # noqa: F401

# pandas ``to_csv`` defaults: comma, double quote, quotes doubled, no header
CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "header": "false"}


def write_posts(posts: DataFrame, path: str) -> None:
    """Append posts, one folder per source (later runs append)."""
    posts.write.mode("append").partitionBy("source").parquet(path)


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_dataset(lines: DataFrame, path: str, order_cols) -> None:
    """One ``line`` column, dataset order, no header, pandas-style quoting.

    ``orderBy`` is a range-partitioned sort, so the files hold the lines in
    order without one big partition.
    """
    lines.orderBy(*order_cols).select("line").write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Read the dataset back (quoted fields may span lines)."""
    return spark.read.schema("line string").options(**CSV_OPTIONS).option("multiLine", "true").csv(path)


def write_split(split_df: DataFrame, path: str) -> None:
    """One example per text line, a folder per split (train / test).

    As in the reference, a line holding raw newlines spans several text lines.
    """
    split_df.select("split", F.col("line").alias("value")).write.mode("overwrite").partitionBy("split").text(path)


def read_split(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def set_arrival_times(spark: SparkSession, path: str, column: str) -> None:
    """Give every file under ``path/column=N`` the modification time N seconds after the epoch's first day.

    A file stream takes files in the order of these times. Metadata only:
    one call a file.
    """
    fs, root = file_system(spark, path)
    files = fs.listFiles(root, True)
    while files.hasNext():
        name = files.next().getPath()
        folder = name.getParent().getName()
        if folder.startswith(f"{column}="):
            fs.setTimes(name, 86_400_000 + 1000 * int(folder.split("=")[1]), -1)


def cached_blocks(spark: SparkSession, cache_root: str, block_size: int, input_key: str, build) -> DataFrame:
    """Token blocks cached as parquet under (block size, input key).

    ``input_key`` stands for the input's content (``file_fingerprint``).
    ``build()`` returns the blocks DataFrame; it runs unless a finished cache
    exists for the key. A half-written cache is overwritten.
    """
    path = f"{cache_root.rstrip('/')}/blocks_{block_size}_{input_key}"
    if not is_finished(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------------------
# Harvest exports: one CSV folder per site (S1, S2, S4 as CSV)
# ---------------------------------------------------------------------------
# The export files the prepare step reads (allow-list).
EXPORT_ALLOW_LIST = ("data_psy_su.csv", "data_psyhelp24_org.csv", "data_b17_ru-1.csv", "data_psycheforum_ru-1.csv")
POST_FIELDS = ("author_id", "author_name", "text", "topic_id", "topic_name", "url", "html")
EXPORT_OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "header": "true"}


def write_post_exports(posts: DataFrame, folder: str, name_of_source) -> None:
    """Write posts as CSV exports, one folder per export name, with a header.

    ``name_of_source`` maps a ``source`` column to the export name.
    """
    out = posts.select(name_of_source(F.col("source")).alias("export"),
                       *[F.col(c).cast("string").alias(c) for c in POST_FIELDS], F.col("pos").cast("string"))
    out.write.mode("overwrite").partitionBy("export").options(**EXPORT_OPTIONS).csv(folder)


def read_post_exports(spark: SparkSession, folder: str, allow=EXPORT_ALLOW_LIST) -> DataFrame:
    """S1 + S2: every field read as a string (multi-line quoted fields),
    the export name taken from the file path and kept only if allowed."""
    schema = ", ".join(f"{c} string" for c in (*POST_FIELDS, "pos"))
    df = (spark.read.schema(schema).options(**EXPORT_OPTIONS).option("multiLine", "true")
               .csv(f"{folder.rstrip('/')}/export=*"))
    export = F.regexp_extract(F.col("_metadata.file_path"), r"export=([^/]+)/", 1)
    return df.withColumn("export", export).filter(F.col("export").isin(*allow))
