"""Shared-folder tables that cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Paths of the tables that this process has made for its own use.
_made: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """Folder all executors see. Read from the session; a local one is made only on a local master."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="lexiforge-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set(CHECKPOINT_KEY, root)
    return root


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet; ``release`` deletes what is there."""
    if not _made:
        atexit.register(_release_at_exit)
    _made.append(f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def release(spark: SparkSession) -> int:
    """Delete all intermediate tables made so far, once no result that reads them is needed any more; how many there were."""
    path, count = spark._jvm.org.apache.hadoop.fs.Path, len(_made)
    for made in _made:
        path(made).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(made), True)
    _made.clear()
    return count


def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        release(spark)


def materialize(df: DataFrame, name: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: later plans reuse the files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
