"""Tokenizer-quality metrics and corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiforge.functions.text import is_byte_token, pystrip


def whitespace_tokens(t: Column) -> Column:
    return F.filter(F.split(t, r"\s+"), lambda w: w != "")


def sample_metrics(samples: DataFrame, tokens: str, text: str, vocab_chars: Column | None = None) -> DataFrame:
    """A10: per-sample columns added to ``samples``; texts without tokens are dropped."""
    n, chars = F.size(tokens), F.length(text)
    total = lambda f: F.aggregate(tokens, F.lit(0).cast("long"), lambda a, x: a + f(F.length(x).cast("long"))) / n
    mean, squares = total(lambda k: k), total(lambda k: k * k)
    covered = F.lit(1.0)
    if vocab_chars is not None:
        own = F.array_distinct(F.split(text, ""))
        covered = F.size(F.array_intersect(own, vocab_chars)) / F.size(own)
    return samples.where((F.size(tokens) > 0) & (F.length(text) > 0)).withColumns({
        "n_tokens": n.cast("long"), "n_chars_": chars.cast("long"), "tokens_per_char": n / chars, "coverage": covered,
        "mean_token_length": mean, "std_token_length": F.sqrt(F.greatest(squares - mean * mean, F.lit(0.0))), "unique_tokens": F.size(F.array_distinct(tokens)).cast("long"),
    })


def with_anomalies(samples: DataFrame, group: str, value: str = "tokens_per_char", threshold: float = 2.0) -> DataFrame:
    """Flag values further than ``threshold`` population deviations from their group's mean; none where there is no deviation.

    The statistics come from an aggregation with partial sums and are joined back, so a group is never gathered in one task.
    """
    stats = samples.groupBy(group).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std"))
    z = F.abs((F.col(value) - F.col("_mean")) / F.nullif(F.col("_std"), F.lit(0.0)))
    return samples.join(stats, group).withColumn("z", z).withColumn("anomaly", F.coalesce(z > threshold, F.lit(False))).drop("_mean", "_std")


def language_metrics(samples: DataFrame, group: str, tokens: str, threshold: float = 2.0) -> DataFrame:
    """One row for each language from rows of ``sample_metrics``."""
    flagged = with_anomalies(samples, group, threshold=threshold)
    per_sample = flagged.groupBy(group).agg(
        F.count("*").alias("samples"), F.avg("n_tokens").alias("mean_tokens"), F.avg("tokens_per_char").alias("mean_ratio"), F.stddev_pop("tokens_per_char").alias("std_ratio"),
        F.avg("coverage").alias("mean_coverage"), F.sum(F.col("anomaly").cast("int")).cast("long").alias("anomalies"),
    )
    # Distinct tokens first, with their number: the pooled length statistics follow from these without exploding twice.
    pooled = samples.select(group, F.explode(tokens).alias("token")).groupBy(group, "token").agg(F.count("*").alias("n")).groupBy(group).agg(
        F.count("*").alias("unique_tokens"), F.sum("n").alias("m"), F.sum(F.col("n") * F.length("token")).alias("s1"), F.sum(F.col("n") * F.length("token") * F.length("token")).alias("s2")
    )
    mean = F.col("s1") / F.col("m")
    pooled = pooled.select(group, "unique_tokens", mean.alias("mean_token_length"), F.sqrt(F.greatest(F.col("s2") / F.col("m") - mean * mean, F.lit(0.0))).alias("std_token_length"))
    return per_sample.join(pooled, group)


def validation(languages: DataFrame, metrics: DataFrame, group: str = "language") -> DataFrame:
    """Every configured language; those without samples have status error."""
    has = F.col("samples").isNotNull()
    return languages.join(metrics, group, "left").withColumn("status", F.when(has, "ok").otherwise("error")).withColumn("error", F.when(~has, "no samples"))


def fertility(samples: DataFrame, n_tokens: Column, text: Column) -> DataFrame:
    """Tokens per sample, tokens per word, characters per token."""
    words = F.size(whitespace_tokens(text))
    return samples.agg(
        (F.sum(n_tokens) / F.count("*")).alias("tokens_per_sample"), (F.sum(n_tokens) / F.nullif(F.sum(words), F.lit(0))).alias("tokens_per_word"), (F.sum(F.length(text)) / F.nullif(F.sum(n_tokens), F.lit(0))).alias("chars_per_token"),
    )


def language_bytes(files: DataFrame, language: str, size: Column) -> DataFrame:
    """Bytes, files and share of each language."""
    total = files.groupBy(language).agg(F.sum(size).cast("long").alias("bytes"), F.count("*").alias("files"))
    everything = F.broadcast(total.agg(F.sum("bytes").alias("all_bytes")))
    return total.crossJoin(everything).select(language, "bytes", "files", (F.col("bytes") / F.col("all_bytes")).alias("share"))


def usability(rows: DataFrame, group: str, text: str = "text") -> DataFrame:
    """Share of non-blank rows, and how many rows that makes."""
    ratio = F.round(F.avg((F.coalesce(pystrip(F.col(text)), F.lit("")) != "").cast("double")), 3)
    return rows.groupBy(group).agg(F.count("*").alias("total_rows"), ratio.alias("usable_ratio")).withColumn("est_usable", F.floor(F.col("usable_ratio") * F.col("total_rows")))


def vocabulary_degeneracy(vocab: DataFrame, token: str = "token") -> DataFrame:
    """Share of byte-level tokens; more than half is a warning."""
    share = F.avg(is_byte_token(F.col(token)).cast("double"))
    return vocab.agg(F.count("*").alias("tokens"), share.alias("byte_share"), (share > 0.5).alias("warn"))


def token_shape(samples: DataFrame, tokens: str) -> DataFrame:
    """Longest token and share of different tokens, added to each row that has tokens."""
    return samples.where(F.size(tokens) > 0).withColumns({
        "longest": F.array_max(F.transform(tokens, lambda x: F.length(x))).cast("long"), "unique_ratio": F.size(F.array_distinct(tokens)) / F.size(tokens),
    })


def convergence(series: DataFrame, step: str = "step", vocab: str = "vocab_size", ratio: str = "compression", run: str | None = None) -> DataFrame:
    """Stability over the last three steps, variance of the last two compression ratios, growth and flags."""
    order = W.partitionBy(run) if run else W.partitionBy(F.lit(0))
    three, two = order.orderBy(step).rowsBetween(-2, 0), order.orderBy(step).rowsBetween(-1, 0)
    top, low = F.max(vocab).over(three), F.min(vocab).over(three)
    full = F.count("*").over(three) >= 3
    stability = F.when(full & (top > 0), 1 - (top - low) / top).otherwise(F.lit(0.0))
    spread = F.coalesce(F.var_samp(ratio).over(two), F.lit(0.0))
    growth = F.coalesce(F.col(vocab) / F.lag(vocab).over(order.orderBy(step)) - 1, F.lit(0.0))
    return series.withColumns({"stability": stability, "spread": spread, "growth": growth}).withColumn("converged", F.col("stability") >= 0.95)


def status_summary(status: DataFrame, column: str = "status") -> DataFrame:
    """Files by state, and the share done in per cent."""
    n = lambda s: F.count_if(F.col(column) == s).alias(s)
    return status.agg(F.count("*").alias("total"), n("done"), n("failed"), n("corrupt")).withColumn("success_rate", F.round(100 * F.col("done") / F.nullif(F.col("total"), F.lit(0)), 1))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, type, rows, nulls) of every column in one pass."""
    names = df.columns
    agg = df.agg(F.count("*").alias("rows"), *[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"n{k}") for k, c in enumerate(names)])
    kinds = dict(df.dtypes)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.coalesce(F.col(f"n{k}"), F.lit(0)).cast("long").alias("nulls")) for k, c in enumerate(names)])
    return agg.select("rows", F.explode(cells).alias("x")).select("x.column", "x.type", "rows", "x.nulls")


def status_counts(status: DataFrame, column: str = "status") -> DataFrame:
    """How many files are in each state."""
    return status.groupBy(column).agg(F.count("*").alias("n"))


def preview(rows: DataFrame, order: list, text: str, most: int = 5, width: int = 80) -> DataFrame:
    """The first ``most`` rows, their text cut to ``width`` characters."""
    return rows.orderBy(*order).limit(most).withColumn(text, F.substring(text, 1, width))
