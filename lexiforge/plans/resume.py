"""Resume, checkpoints and progress as tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROGRESS = "dataset_id string, status string, rows long"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def finished(spark: SparkSession, path: str) -> bool:
    """Whether an output was committed whole."""
    fs, p = _path(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def once(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``, made only if it is not there whole."""
    if not finished(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def progress(spark: SparkSession, path: str) -> DataFrame:
    """Latest status of each dataset."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS + ", at long").json(path).groupBy("dataset_id").agg(F.max_by("status", "at").alias("status"), F.max_by("rows", "at").alias("rows"))


def record(spark: SparkSession, path: str, dataset_id: str, status: str, rows: int, at: int) -> None:
    """Appends a status; ``at`` orders the statuses of a dataset."""
    spark.createDataFrame([(dataset_id, status, rows, at)], PROGRESS + ", at long").write.mode("append").json(path)


def save_round(spark: SparkSession, folder: str, number: int, seqs: DataFrame, state: dict) -> None:
    """A training round's sequences, and the state beside them; a round counts once its state is written."""
    seqs.write.mode("overwrite").parquet(f"{folder}/round={number}/sequences")
    spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode("overwrite").text(f"{folder}/round={number}/state")


def rounds(spark: SparkSession, folder: str) -> list[int]:
    """The whole rounds of a folder, in order."""
    fs, p = _path(spark, folder)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    found = sorted(int(n[6:]) for n in names if n.startswith("round=") and n[6:].isdigit())
    return [n for n in found if finished(spark, f"{folder}/round={n}/state")]


def latest(spark: SparkSession, folder: str) -> tuple[int, DataFrame, dict] | None:
    """The last whole round: (number, sequences, state)."""
    have = rounds(spark, folder)
    if not have:
        return None
    at = f"{folder}/round={have[-1]}"
    return have[-1], spark.read.parquet(f"{at}/sequences"), json.loads(spark.read.text(f"{at}/state").first()[0])
