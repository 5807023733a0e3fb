"""Session, table reading and lineage cutting shared by all operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("folioweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = sc.getConf().get("spark.checkpoint.dir")
    if not shared and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    # Only a local session may do without a shared folder.
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="folioweave-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared checkpoint folder and cut its lineage.

    The files outlive executors, so later reads never depend on blocks of a lost one. Spark deletes them with their
    DataFrame where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that materialises a DataFrame as compressed columns in a new folder beside the checkpoints; the folder goes
    with the block, and the shuffle files of every query made inside with its end."""
    _ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/kept-{uuid.uuid4().hex}"
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    made = 0

    def keep(df: DataFrame) -> DataFrame:
        nonlocal made
        made += 1
        df.write.option("compression", "zstd").parquet(f"{folder}/{made}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{made}")

    spark.conf.set(cleanup, "true")
    try:
        yield keep
    finally:
        if before is None:
            spark.conf.unset(cleanup)
        else:
            spark.conf.set(cleanup, before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(df: DataFrame) -> int:
    """The shuffle partition count of the session, as an int."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
