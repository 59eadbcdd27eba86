"""Sampling and budgets; every random choice has a seed and a rank by md5, so that runs repeat."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def shuffle_key(column: str, seed: int = 0) -> Column:
    return F.md5(F.concat(F.col(column).cast("string"), F.lit(f":{seed}")))


def bucket(column: str, seed: int = 0) -> Column:
    """A uniform number in [0, 1) from the key's md5."""
    return F.conv(F.substring(shuffle_key(column, seed), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def bernoulli(df: DataFrame, column: str, share: float, seed: int = 0) -> DataFrame:
    """keep each row with probability ``share``."""
    return df.where(bucket(column, seed) < share)


def first_per_group(df: DataFrame, group: str, order: list, most: int) -> DataFrame:
    """At most ``most`` rows of each group. Spark turns the rank filter into a top-k for each group before the shuffle."""
    rank = F.row_number().over(W.partitionBy(group).orderBy(*order))
    return df.withColumn("rn", rank).where(F.col("rn") <= most).drop("rn")


def discovery_share(gb: float | None) -> float:
    """share of files to look at for a size in GB."""
    if not gb or gb <= 0:
        return 0.40
    return min(0.60, max(0.25, 0.25 + 0.08 * math.log10(gb)))


def discovery_sample(files: DataFrame, dataset: str, key: str, share: float, seed: int = 0) -> DataFrame:
    """``share`` of each dataset's files, one at least."""
    sizes = files.groupBy(dataset).agg(F.greatest(F.lit(1), F.floor(F.count("*") * share)).cast("int").alias("take"))
    ranked = files.withColumn("rn", F.row_number().over(W.partitionBy(dataset).orderBy(shuffle_key(key, seed), key)))
    return ranked.join(sizes, dataset).where("rn <= take").drop("rn", "take")


def budget_sample(files: DataFrame, language: str, size: str, key: str, target: int, seed: int = 0) -> DataFrame:
    """shuffled files of each language until its share of ``target`` bytes is reached; the crossing file stays."""
    total = files.groupBy(language).agg(F.sum(size).alias("lang_bytes"))
    shares = total.crossJoin(F.broadcast(total.agg(F.sum("lang_bytes").alias("all_bytes")))).select(language, F.floor(F.lit(target) * F.col("lang_bytes") / F.col("all_bytes")).alias("budget"))
    # Running sums in two steps: over at most 4096 ranges of the shuffle key for each language, then within a range.
    keyed = files.withColumn("order_", shuffle_key(key, seed)).withColumn("range_", F.substring("order_", 1, 3))
    behind = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    ranges = keyed.groupBy(language, "range_").agg(F.sum(size).alias("range_size"))
    starts = ranges.select(language, "range_", F.coalesce(F.sum("range_size").over(behind(W.partitionBy(language).orderBy("range_"))), F.lit(0)).alias("start_"))
    inside = F.coalesce(F.sum(size).over(behind(W.partitionBy(language, "range_").orderBy("order_", key))), F.lit(0))
    rows = keyed.withColumn("inside_", inside).join(starts, [language, "range_"]).join(shares, language)
    return rows.where(F.col("start_") + F.col("inside_") < F.col("budget")).select(*files.columns)


def size_in_gb(literal: str) -> float:
    """F10 for parameters; raises ValueError for anything but a positive MB, GB or TB."""
    found = re.fullmatch(r"(\d+(?:\.\d+)?)\s*(MB|GB|TB)", literal.strip().upper())
    value = float(found[1]) * {"MB": 1e-3, "GB": 1.0, "TB": 1e3}[found[2]] if found else 0.0
    if value <= 0:
        raise ValueError(f"no positive size in MB, GB or TB: {literal!r}")
    return value


def component_budget(max_samples: int, languages_per_dataset: list[int]) -> int:
    """rows for each (dataset, language)."""
    return max_samples // sum(max(1, n) for n in languages_per_dataset)


def auto_sample_sizes(gb: float, vocab: int) -> tuple[int, int]:
    """initial and largest sample."""
    factor = max(1.0, vocab / 32000) * max(1.0, gb / 5)
    return min(int(100_000 * factor), 2_000_000), min(int(1_000_000 * factor), 10_000_000)


def shard(df: DataFrame, key: str, index: int, count: int) -> DataFrame:
    """S05 for catalogues of files: sorted by key, every ``count``-th row from ``index``."""
    if count <= 1:
        return df.orderBy(key)
    return df.withColumn("rn", F.row_number().over(W.orderBy(key)) - 1).where(F.pmod("rn", F.lit(count)) == index).drop("rn").orderBy(key)


def adaptive_min_frequency(rows: int, base: int = 2) -> int:
    """smallest pair count, raised with the number of different sequences."""
    for above, least, factor in ((100_000_000, 10, 2.0), (10_000_000, 5, 1.5), (1_000_000, 3, 1.0)):
        if rows > above:
            return max(least, int(base * factor))
    return max(2, base)


def merges_per_round(memory_gb: float, vocab: int) -> int:
    """Merges accepted in one round."""
    base = min(16_000, vocab // 8)
    for least, most, factor in ((128, 20_000, 2.0), (64, 16_000, 1.0), (32, 12_000, 0.8), (16, 8_000, 0.6)):
        if memory_gb >= least:
            return min(most, int(base * factor))
    return min(4_000, int(base * 0.4))


def chunk_size(normal: int, memory_used: float) -> int:
    """Rows to take at once: a quarter over 90 % of memory, half over 80 %, 1000 at least."""
    return max(1000, normal // (4 if memory_used > 0.9 else 2 if memory_used > 0.8 else 1))


def frequent(counts: DataFrame, least: int, column: str = "count") -> DataFrame:
    """entries that are frequent enough."""
    return counts.where(F.col(column) >= least)
