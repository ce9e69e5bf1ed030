"""Structured Streaming jobs.

* U1 ``stream_ingest``: a file-source stream of harvested post files,
  appended to a parquet sink with a checkpoint; each file is taken exactly
  once, so a stopped harvest resumes where it left off (no repeated header
  rows to clean, unlike appended CSV exports). ``trigger(availableNow)``
  processes what is there and stops; ``maxFilesPerTrigger`` bounds a
  micro-batch (the count-limited test run).
* U2 ``stream_extract``: page files -> posts. The token windows of the
  extraction are not allowed on a stream, so each micro-batch runs the batch
  extraction in ``foreachBatch`` (pages are independent of each other).
* U1 + C5 ``stream_dedup``: posts of repeated crawls, every (url, content)
  once, with the keys in watermarked state.
* U3 ``stream_prompts``: chat turns -> prompts over the last ``history``
  turns of each conversation, with the history, the turns that came too early
  and a timer in keyed state (``transformWithStateInPandas``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from threadloom.operators.encode import chat_turns
from threadloom.operators.extract import posts_from_pages
from threadloom.functions.text import length_code, token_count


def run_available(query_writer, checkpoint: str, timeout_s: int | None = None):
    """Start a stream with ``trigger(availableNow=True)`` and wait until all of its input is in.

    ``timeout_s`` (none by default) stops a stream that takes longer; the
    checkpoint lets a later run go on where it stopped.
    """
    q = query_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError("stream did not finish")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def stream_ingest(spark: SparkSession, src_dir: str, schema, sink_dir: str, checkpoint: str,
                  max_files: int | None = None) -> DataFrame:
    """Append every new post file under ``src_dir`` to ``sink_dir``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(src_dir)
    run_available(stream.writeStream.format("parquet").outputMode("append").option("path", sink_dir), checkpoint)
    return spark.read.parquet(sink_dir)


def stream_extract(spark: SparkSession, pages_dir: str, schema, sink_dir: str, checkpoint: str,
                   max_files: int | None = None) -> DataFrame:
    """Extract posts from every new page file, one micro-batch at a time."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    pages = reader.parquet(pages_dir)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # idempotent per batch id: a replayed batch overwrites its own folder
        out = posts_from_pages(batch).filter("ready").withColumn("batch_id", F.lit(batch_id))
        out.write.mode("overwrite").parquet(f"{sink_dir}/batch_id={batch_id}")

    run_available(pages.writeStream.foreachBatch(per_batch), checkpoint)
    return spark.read.parquet(sink_dir)


def stream_dedup(spark: SparkSession, src_dir: str, schema, sink_dir: str, checkpoint: str, key_cols: Sequence[str] = ("url", "text"),
                 ts_col: str = "harvested_at", delay: str = "30 days", max_files: int | None = None) -> DataFrame:
    """U1 + C5: posts of repeated crawls, each (url, content) appended once.

    State holds the keys (the columns' hash stands for long contents) until
    ``delay`` of event time has gone by without them, so its size is that of a
    delay's harvest; it is keyed by the hash, so a topic's posts spread over
    tasks. A copy that comes later than ``delay`` after its first one passes
    again, a post older than the watermark is dropped as late. Null columns are
    equal to each other. Only ``key_cols`` come out: they are what copies share.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    digest = F.sha2(F.to_json(F.struct(*key_cols), {"ignoreNullFields": "false"}), 256)
    posts = reader.parquet(src_dir).select(*key_cols, ts_col, digest.alias("_key")).withWatermark(ts_col, delay)
    once = posts.dropDuplicatesWithinWatermark(["_key"]).drop("_key", ts_col)
    run_available(once.writeStream.format("parquet").outputMode("append").option("path", sink_dir), checkpoint)
    return spark.read.schema(once.schema).parquet(sink_dir)


PROMPT_SCHEMA = "conv_id long, turn long, prompt string"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class PromptProcessor(StatefulProcessor):
    """The turns of a conversation in their order, however they arrive, and a prompt for every user turn.

    ``said``: value state of the turn to come, the last pieces said and how many turns wait.
    ``waiting``: map state of turns that came before one that is still missing, by turn. Every call to
    a state is a round trip of the worker, so a conversation costs one read and one write of ``said``
    a batch, and of ``waiting`` only what waits. A timer that each arrival
    sets anew ends the waiting: after ``patience_ms`` of processing time without a missing turn the
    conversation goes on without it; 0 waits for ever. A turn that comes after that, or twice, is dropped.
    """

    def __init__(self, history: int, wanted_length: str, patience_ms: int = 0):
        self.keep, self.ending, self.patience = history, f"|1|{wanted_length}|", patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.said = handle.getValueState("said", "next long, history array<string>, waiting long")
        self.waiting = handle.getMapState("waiting", "turn long", "speaker int, piece string")

    def _load(self) -> tuple[int, list[str], dict[int, tuple]]:
        """The turn to come, the last pieces said, the turns that wait."""
        said = self.said.get()
        if said is None:
            return 0, [], {}
        start, held, n = said
        return start, list(held), {k[0]: tuple(v) for k, v in self.waiting.iterator()} if n else {}

    def _say(self, key, start: int, held: list[str], before: dict[int, tuple], arrived: dict[int, tuple], skip: bool) -> Iterator[pd.DataFrame]:
        """Say the turns from ``start`` on as far as they are there (all of them with ``skip``), keep the others waiting."""
        turns, prompts = [], []
        order = sorted(t for t in arrived if t >= start)
        for turn in order:
            if turn != start and not skip:
                break
            speaker, piece = arrived.pop(turn)
            if speaker is not None:  # system turns only hold their place
                held = [*held, piece][-self.keep:]
                if speaker == 0:
                    turns.append(turn)
                    prompts.append("".join(held) + self.ending)
            start = turn + 1
        for turn in before.keys() - arrived.keys():
            self.waiting.removeKey((turn,))
        for turn in arrived.keys() - before.keys():
            self.waiting.updateValue((turn,), arrived[turn])
        self.said.update((start, held, len(arrived)))
        if turns:
            yield pd.DataFrame({"conv_id": pd.Series([key[0]] * len(turns), dtype="int64"), "turn": pd.Series(turns, dtype="int64"),
                                "prompt": pd.Series(prompts, dtype="object")})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start, held, waiting = self._load()
        arrived = dict(waiting)
        for frame in rows:
            for turn, speaker, piece in zip(frame["turn"].tolist(), frame["speaker"].tolist(), frame["piece"].tolist()):
                if turn >= start:
                    arrived.setdefault(turn, (None if pd.isna(speaker) else int(speaker), piece))
        yield from self._say(key, start, held, waiting, arrived, skip=False)
        if self.patience:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if arrived:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, held, waiting = self._load()
        yield from self._say(key, start, held, waiting, dict(waiting), skip=True)

    def close(self) -> None:
        pass


def stream_prompts(spark: SparkSession, turns_dir: str, schema, sink_dir: str, checkpoint: str,
                   history: int = 5, wanted_length: str = "-", max_files: int | None = 1, patience_ms: int = 0) -> DataFrame:
    """Prompts of user turns from a stream of conversation turns.

    Turns of a conversation (numbered from 0) may arrive in any order, over any
    micro-batches: what comes early waits in state for the turns before it, and
    a prompt is out once all of them are in (or ``patience_ms`` have gone by).
    The state is the last ``history`` pieces and the turns that wait. It needs the
    RocksDB state store, which is set for this stream alone.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    t = chat_turns(reader.parquet(turns_dir), keep_system=True)
    ln = length_code(token_count(F.coalesce(F.col("text"), F.lit(""))))
    t = t.withColumn("piece", F.concat(F.lit("|"), F.col("speaker").cast("string"), F.lit("|"), ln, F.lit("|"),
                                       F.coalesce(F.col("text"), F.lit(""))))
    t = t.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "speaker", "piece")
    out = t.where("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id").transformWithStateInPandas(
        PromptProcessor(history, wanted_length, patience_ms), outputStructType=PROMPT_SCHEMA, outputMode="append",
        timeMode="ProcessingTime" if patience_ms else "None")
    key, before = "spark.sql.streaming.stateStore.providerClass", None
    before = spark.conf.get(key, None)
    spark.conf.set(key, STATE_STORE)
    try:
        run_available(out.writeStream.format("parquet").outputMode("append").option("path", sink_dir), checkpoint)
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
    return spark.read.schema(PROMPT_SCHEMA).parquet(sink_dir)
