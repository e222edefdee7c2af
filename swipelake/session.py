"""Session set-up and lineage cutting shared by all jobs."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Seconds: what takes less has left no shuffles worth looking for.
LONG = 3.0


def get_session(app_name: str, hive: bool = False, conf: dict[str, str] | None = None) -> SparkSession:
    """One session for every job. Master, memory and partition counts come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would lose the data together with its machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="swipelake-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared checkpoint folder.

    For results that are read more than once and must be the same each time: a sum of doubles
    that is computed again after a lost executor may differ in its last bit.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_at(df: DataFrame, path: str | None = None, **options: str) -> tuple[DataFrame, str]:
    """``df`` as compressed Parquet, by default in the shared checkpoint folder, and its folder.

    For large results that are read more than once: a checkpoint is neither compressed nor taken away before the session ends.
    """
    spark, kinds = df.sparkSession, df.schema
    path = path or f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    began = time.monotonic()
    df.write.options(**{"compression": "zstd"} | options).parquet(path)
    del df
    if time.monotonic() - began > LONG:
        release_shuffles(spark)
    return spark.read.schema(kinds).parquet(path), path


@contextmanager
def stored(df: DataFrame, **options: str) -> Iterator[DataFrame]:
    """The same for as long as the block lasts."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    frames = [df]
    del df
    try:
        yield stored_at(frames.pop(), path, **options)[0]
    finally:
        remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nobody holds any more: it does so when the driver collects garbage,
    which a driver with room to spare may not do for half an hour."""
    gc.collect()
    spark._jvm.System.gc()
