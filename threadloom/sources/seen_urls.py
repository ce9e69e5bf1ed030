"""The set of urls that earlier harvest runs have met, kept across runs.

The set lies in a folder as generations of urls. A generation is a table
bucketed and sorted by url, one file per bucket, so a run shuffles its own urls
once and merge-anti-joins every generation where it lies: the old urls are read in
order, never shuffled. A run's new urls become a generation of their own; when
``fanout`` generations of a size class have come together they are merged bucket by
bucket into one. A generation counts once its success marker is there, so a run that
broke off leaves nothing behind, and its repetition writes the same generation anew.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.session import file_system, is_finished


class SeenUrls:
    """A persistent url set under ``path`` (a folder every executor can reach).

    ``buckets`` is fixed when the set is begun: about one per 128 MB of urls
    that the set will hold.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, fanout: int = 4):
        if fanout < 2 or buckets < 1:
            raise ValueError("a bucket at least, and two generations to a merge")
        self.spark, self.path, self.buckets, self.fanout = spark, path.rstrip("/"), buckets, fanout

    def generations(self) -> list[tuple[int, int]]:
        """``(level, number)`` of the generations that count, oldest last."""
        fs, folder = file_system(self.spark, self.path)
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        found = [tuple(map(int, n.split("-")[1:])) for n in names if n.startswith("gen-") and is_finished(self.spark, f"{self.path}/{n}")]
        return sorted((g for g in found if not self._merged(*g, found)), reverse=True)

    @staticmethod
    def _merged(level: int, number: int, found: list[tuple[int, int]]) -> bool:
        """Has a merge taken this generation up? Merges are named by the last generation they hold."""
        return any(other > level and last >= number for other, last in found)

    def _folder(self, level: int, number: int) -> str:
        return f"{self.path}/gen-{level}-{number}"

    def _table(self, level: int, number: int) -> DataFrame:
        """A generation with its buckets and order, whichever session wrote it."""
        folder = self._folder(level, number)
        name = f"threadloom_seen_{hashlib.md5(folder.encode()).hexdigest()}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (url STRING) USING parquet CLUSTERED BY (url) SORTED BY (url) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{folder}'")
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def _write(self, urls: DataFrame, level: int, number: int) -> None:
        name = f"threadloom_seen_write_{uuid.uuid4().hex}"
        (urls.select("url").repartition(self.buckets, "url").write.format("parquet").mode("overwrite")
         .bucketBy(self.buckets, "url").sortBy("url").option("path", self._folder(level, number)).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")  # an external table: the files stay

    def unseen(self, urls: DataFrame, url_col: str = "url") -> DataFrame:
        """The distinct, non-null urls of ``urls`` that no generation holds, as one column ``url``."""
        new = urls.select(F.col(url_col).alias("url")).where(F.col("url").isNotNull()).repartition(self.buckets, "url").distinct()
        for level, number in self.generations():
            new = new.join(self._table(level, number).hint("merge"), "url", "left_anti")
        return new

    def extend(self, urls: DataFrame) -> None:
        """Add ``urls`` (from ``unseen``, or any) as a generation, and merge generations that have become many."""
        gens = self.generations()
        number = 1 + max((n for _, n in gens), default=-1)
        self._write(self.unseen(urls), 0, number)
        level = 0
        while True:
            same = [g for g in self.generations() if g[0] == level]
            if len(same) < self.fanout:
                return
            whole = self._table(*same[0])
            for g in same[1:]:
                whole = whole.unionByName(self._table(*g))
            top = max(n for _, n in same)
            self._write(whole, level + 1, top)
            fs, _ = file_system(self.spark, self.path)
            for g in same:  # the merge holds them and counts from now on
                fs.delete(file_system(self.spark, self._folder(*g))[1], True)
            level += 1

    def urls(self) -> DataFrame:
        """All urls of the set, each once."""
        out = self.spark.createDataFrame([], "url string")
        for g in self.generations():
            out = out.unionByName(self._table(*g))
        return out
