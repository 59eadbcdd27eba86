"""Counting: sequences, characters, adjacent pairs and tokens, each one partial and one final aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiforge.functions.text import characters, pystrip, sequence_key


def text_counts(docs: DataFrame, text: Column | str = "text") -> DataFrame:
    """(text, count) of equal non-empty texts after stripping."""
    t = F.col(text) if isinstance(text, str) else text
    return docs.select(pystrip(t).alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("count"))


def sequence_counts(docs: DataFrame, text: Column | str = "text") -> DataFrame:
    """(seq, count); texts are grouped as they are and written as code points once each."""
    return text_counts(docs, text).select(sequence_key(F.col("text")).alias("seq"), "count")


def sharded_counts(docs: DataFrame, shard: Column, text: Column | str = "text") -> DataFrame:
    """A01 for every shard at once: (shard, seq, count), from one scan."""
    t = F.col(text) if isinstance(text, str) else text
    grouped = docs.select(shard.alias("shard"), pystrip(t).alias("text")).where("text <> ''").groupBy("shard", "text").agg(F.count("*").alias("count"))
    return grouped.select("shard", sequence_key(F.col("text")).alias("seq"), "count")


def merged_counts(parts: DataFrame) -> DataFrame:
    """Counts of all files by sequence; rows without a sequence or a positive count are dropped."""
    good = parts.where("seq is not null and seq <> '' and count > 0")
    return good.groupBy("seq").agg(F.sum("count").cast("long").alias("count"))


def neighbours(text: Column) -> Column:
    """Adjacent pairs of a text's characters, as strings of two characters: each match looks at two and takes one."""
    return F.regexp_extract_all(text, F.lit("(?s)(?=(..))."), 1)


def _as_codepoints(pairs: DataFrame, *rest: str) -> DataFrame:
    return pairs.select(F.ascii("pair").alias("a"), F.ascii(F.substring("pair", 2, 1)).alias("b"), *rest)


def weighted_pairs(counts: DataFrame) -> DataFrame:
    """(a, b, cnt) over (text, count); overlapping pairs all count."""
    exploded = counts.select(F.explode(neighbours(F.col("text"))).alias("pair"), "count")
    return _as_codepoints(exploded.groupBy("pair").agg(F.sum("count").cast("long").alias("cnt")), "cnt")


def document_pairs(docs: DataFrame, text: str = "text") -> DataFrame:
    """(a, b, df): in how many texts each pair stands."""
    exploded = docs.select(F.explode(F.array_distinct(neighbours(F.col(text)))).alias("pair"))
    return _as_codepoints(exploded.groupBy("pair").agg(F.count("*").alias("df")), "df")


def character_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(codepoint, count)."""
    return docs.select(F.explode(characters(F.col(text))).alias("c")).groupBy("c").agg(F.count("*").alias("count")).select(F.ascii("c").alias("codepoint"), "count")


def token_counts(docs: DataFrame, tokens: Column) -> DataFrame:
    """(token, count)."""
    return docs.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("count"))


def top_pairs(pairs: DataFrame, k: int, min_frequency: int = 1, exclude: DataFrame | None = None) -> DataFrame:
    """The k most frequent pairs, ties by (a, b); pairs of ``exclude`` are left out."""
    pairs = pairs.where(F.col("cnt") >= min_frequency)
    if exclude is not None:
        pairs = pairs.join(exclude.select("a", "b"), ["a", "b"], "left_anti")
    return pairs.orderBy(F.desc("cnt"), "a", "b").limit(k)


def conflict_free(ranked: list[tuple[int, int, int]], most: int) -> list[tuple[int, int, int]]:
    """From the most frequent down, pairs neither of whose symbols is taken; bounded by the top-k before it."""
    taken: set[int] = set()
    out = []
    for a, b, cnt in ranked:
        if len(out) >= most:
            break
        if a not in taken and b not in taken:
            taken |= {a, b}
            out.append((a, b, cnt))
    return out


def pass_stats(counts: DataFrame, size: Column) -> DataFrame:
    """Different sequences, expanded tokens."""
    return counts.agg(F.count("*").alias("sequences"), F.sum(size * F.col("count")).cast("long").alias("tokens"))
