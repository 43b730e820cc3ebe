"""Session set-up, the shared scratch folder, and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting for the shuffle files of a finished query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "cohorta", master: str | None = None, conf: dict | None = None) -> SparkSession:
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Checkpoint files of a finished loop round go away with the frame that owned them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _checkpoint_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's setting, or a temporary one in local mode only."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current is None:
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="cohorta-")
        sc.setCheckpointDir(named)
        current = sc.getCheckpointDir()
    return named or current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the shared scratch root."""
    root = _checkpoint_root(spark).rstrip("/")
    return f"{root}/cohorta-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later steps restart from files, not from the whole history."""
    _checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run within are deleted once it is done, not at some collection of the driver."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def write(df: DataFrame, path: str) -> None:
    with tidy(df.sparkSession):
        df.write.parquet(path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table to scratch and read it back: cuts lineage, keeps column pruning and size statistics."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    write(df, path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any file system that Spark reaches."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@dataclass(frozen=True)
class Bucketed:
    """A written table whose rows are placed by a key as a shuffle would place them, so that joins and groups on it need none."""
    table: DataFrame
    name: str
    path: str

    def drop(self) -> None:
        spark = self.table.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove(spark, self.path)


def bucketed(df: DataFrame, key: str, label: str) -> Bucketed:
    """Write a table to scratch in as many buckets of a key as shuffles have partitions. A frame that was grouped or
    repartitioned by the key already is written as it lies."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = f"cohorta_{label.replace('-', '_')}_{path.rsplit('-', 1)[1]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with tidy(spark):
        df.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return Bucketed(spark.table(name), name, path)


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, 1)
