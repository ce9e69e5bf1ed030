"""Spark session helpers shared by tests, bench and the driver entry."""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans shuffles from runtime
# sizes (coalesces small partitions, splits skewed join partitions), and the
# broadcast threshold is left at Spark's size-checked default. The token
# stages are CPU-heavy per byte, so coalesced partitions may be small (512k)
# and small inputs still use every core; large inputs are unaffected.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "512k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "threadloom") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("THREADLOOM_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; set a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a local session without it (tests) gets a fresh temp folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is unset; a cluster job needs a shared folder there")
    path = tempfile.mkdtemp(prefix="threadloom-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def job_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder for job output / streaming checkpoints inside the shared
    checkpoint folder (never a machine-local temp dir on a cluster)."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = "/".join([base, "threadloom", *parts])
    return f"{path}/{uuid.uuid4().hex}" if unique else path


def materialize(df, name: str):
    """Write ``df`` as a parquet stage table in the shared checkpoint folder
    and read it back.

    Used where one stage output feeds several consumers (self-joins of the
    bucketed scans, chain and quote branches): the stage is computed once,
    its lineage is cut, and a lost executor costs a re-read, not a re-run of
    the upstream pipeline.
    """
    spark = df.sparkSession
    path = job_dir(spark, "stage", name)
    df.write.mode("overwrite").parquet(path)
    drop_at_end(spark, path)
    return spark.read.parquet(path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop_at_end(spark: SparkSession, path: str) -> None:
    """Have the driver delete ``path`` when it shuts down."""
    fs, p = file_system(spark, path)
    fs.deleteOnExit(p)


def is_finished(spark: SparkSession, path: str) -> bool:
    """True if a write to ``path`` ended well (its success marker is there)."""
    fs, p = file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def file_fingerprint(source) -> str:
    """Digest of the names, sizes and change times of the files behind ``source``; changed data has another one."""
    spark = source.sparkSession
    digest = hashlib.md5()
    for name in sorted(source.inputFiles()):
        fs, p = file_system(spark, name)
        status = fs.getFileStatus(p)
        digest.update(f"{name}:{status.getLen()}:{status.getModificationTime()};".encode())
    return digest.hexdigest()[:16]


def shared_stage(spark: SparkSession, name: str, source, build):
    """A stage table that the queries of one application share, by the content of ``source``'s files.

    ``build()`` runs unless a finished one is there; a half-written one is
    built again.
    """
    path = job_dir(spark, "shared", spark.sparkContext.applicationId, f"{name}-{file_fingerprint(source)}", unique=False)
    if not is_finished(spark, path):
        build().write.mode("overwrite").parquet(path)
        drop_at_end(spark, path)
    return spark.read.parquet(path)
