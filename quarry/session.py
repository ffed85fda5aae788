"""Session helpers: one place that knows how a local session is configured and
where lineage-cutting checkpoints go.

On a cluster the session is created by the platform; we only *read*
``spark.checkpoint.dir`` from it. A local default is set only when nothing is
configured (tests, bench)."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    """Session for tests and the bench. AQE on, UI off, UTC clock."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the configured checkpoint folder; set a scratch one only if unset."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # Only reached in local runs (tests, bench) where nothing is configured.
    local_dir = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("QUARRY_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local_dir)
    spark.sparkContext.setCheckpointDir(local_dir)
    return local_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Rows that several passes read: written once as Parquet under the shared checkpoint folder and read from there.
    Later passes read the columns they need of them, packed."""
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def brief_shuffles(spark: SparkSession):
    """Within it, an action's shuffle files go when the action has ended, not when the driver's garbage collector comes
    by. For runs of many actions whose frames start from written tables, so that no later one needs those files."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """The tables that one run writes under the shared checkpoint folder; each can be dropped once nothing reads it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.kept, self.made = spark, scratch_path(spark, name), {}, 0

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` as written rows. Its columns are mostly hashes: no dictionaries."""
        at, self.made = f"{self.path}/{self.made}", self.made + 1
        df.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(at)
        out = self.spark.read.schema(df.schema).parquet(at)
        self.kept[id(out)] = (at, out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.kept.pop(id(t))[0])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
