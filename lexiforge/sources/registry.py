"""Dataset registry and configuration."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "ord int, dataset string, field string, extra array<string>, priority int"


def registry(spark: SparkSession, entries: list[tuple[str, str, list[str] | None, int]]) -> DataFrame:
    """(dataset, field, language configs, priority) entries in order."""
    return spark.createDataFrame([(k, *e) for k, e in enumerate(entries)], SCHEMA)


def expanded(reg: DataFrame) -> DataFrame:
    """A row for each dataset and language config, with an id."""
    rows = reg.select("*", F.explode_outer("extra").alias("config"))
    return rows.withColumn("dataset_id", F.concat_ws(":", "dataset", "config")).drop("extra")


def selection(reg: DataFrame, names: list[str] | None = None, priority: int | None = None, processed: DataFrame | None = None) -> DataFrame:
    """What is left to read, by priority and then in registry order."""
    rows = expanded(reg)
    if names is not None:
        rows = rows.where(F.col("dataset").isin(names))
    if priority is not None:
        rows = rows.where(F.col("priority") <= priority)
    if processed is not None:
        rows = rows.join(processed.select("dataset_id"), "dataset_id", "left_anti")
    return rows.orderBy("priority", "ord", "config")


def matched_configs(languages: DataFrame, variants: DataFrame, configs: DataFrame) -> DataFrame:
    """(lang, config) by exact name, variant in the name, ".lang" suffix or "lang_" prefix, the first that hits; else the code.

    All three tables are small catalogues of names.
    """
    lang, config = F.col("lang"), F.lower("config")
    wide = languages.join(F.broadcast(configs)).join(variants, "lang", "left")
    by = F.when(config == lang, 1).when(config.contains(F.col("variant")), 2).when(config.endswith(F.concat(F.lit("."), lang)), 3).when(config.startswith(F.concat(lang, F.lit("_"))), 4)
    hits = wide.withColumn("by", by).where("by is not null").groupBy("lang").agg(F.min_by("config", F.struct("by", "config")).alias("hit"))
    return languages.join(hits, "lang", "left").select("lang", F.coalesce("hit", "lang").alias("config"))


def allowed(names: DataFrame, prefixes: list[str], column: str = "dataset") -> DataFrame:
    """names that begin with one of the prefixes."""
    test = F.lit(False)
    for p in prefixes:
        test = test | F.col(column).startswith(p)
    return names.where(test)


def shard_index(given: int | None = None, env: tuple[str, ...] = ("SLURM_ARRAY_TASK_ID", "SHARD_INDEX")) -> int:
    """A given index, else that of the first variable that is set, else 0."""
    if given is not None:
        return given
    return next((int(os.environ[k]) for k in env if os.environ.get(k, "").isdigit()), 0)


@dataclass
class ValidationConfig:
    """Checked settings of a validation."""

    tokenizer: str
    languages: list[str]
    z_threshold: float = 2.0
    min_samples: int = 1
    output: str | None = None
    extra: dict = field(default_factory=dict)

    @classmethod
    def load(cls, values: dict) -> ValidationConfig:
        missing = [k for k in ("tokenizer", "languages") if k not in values]
        if missing:
            raise ValueError(f"missing: {', '.join(missing)}")
        known = {f.name for f in fields(cls)} - {"extra"}
        out = cls(**{k: v for k, v in values.items() if k in known}, extra={k: v for k, v in values.items() if k not in known})
        if not isinstance(out.languages, list) or not out.languages or not all(isinstance(x, str) for x in out.languages):
            raise ValueError("languages is to be a list of codes")
        if not isinstance(out.z_threshold, (int, float)) or out.z_threshold <= 0:
            raise ValueError("z_threshold is to be a positive number")
        return out
