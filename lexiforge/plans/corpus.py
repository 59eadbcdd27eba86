"""End-to-end plans: catalogue to manifest, files to counts to tokenizer, samples to a validation report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.functions.text import decided_language, letter_language, sequence_key, stop_word_language, vote
from lexiforge.functions.unicode import prepared
from lexiforge.operators import counts, metrics
from lexiforge.plans import bpe
from lexiforge.plans.encode import longest_matches
from lexiforge.sources import catalog, readers, sinks


def profiled(rows: DataFrame, file: str, order: str, text: str = "text") -> DataFrame:
    """(file, language, usable_ratio, est_usable, total_rows): a language by vote on a sample of each file, and how much is usable."""
    sample = catalog.micro_sample(rows, file, order, text)
    content = F.col("content")
    voted = vote([stop_word_language(content), letter_language(content)])
    return sample.select(file, decided_language(content, voted).alias("language")).join(metrics.usability(rows, file, text), file)


def counted(spark: SparkSession, paths: list[str], target: str, form: str = "NFC", lowercase: bool = False, strip_accents: bool = False) -> DataFrame:
    """Scan to counts: one shuffle, written sorted; (seq, count)."""
    texts = readers.parquet_texts(spark, paths)
    grouped = counts.text_counts(texts, prepared(F.col("text"), form, lowercase, strip_accents))
    sinks.write_counts(grouped.select(sequence_key(F.col("text")).alias("seq"), "count"), target)
    return readers.counts(spark, target, "jsonl")


def trained(seqs: DataFrame, folder: str | None = None, specials: tuple[str, ...] = (), **settings) -> bpe.Trained:
    """Counts (seq string, count) to a tokenizer, with its files in ``folder`` if one is given."""
    points = seqs.select(F.transform(F.split("seq", " "), lambda x: x.cast("int")).alias("seq"), "count")
    done = bpe.train(points, specials=len(specials), **settings)
    if folder:
        base = [chr(r[0]) for r in points.select(F.explode("seq")).distinct().orderBy("col").collect()]  # an alphabet
        sinks.write_files(folder, bpe.artifacts(base + list(done.tokens.values()), [(done.text(a), done.text(b)) for _, a, b, _, _ in done.merges], list(specials), {"rounds": done.rounds, "stopped": done.stopped}))
    return done


def validated(samples: DataFrame, languages: list[str], vocabulary: list[str], threshold: float = 2.0) -> DataFrame:
    """(language, sample) rows to one row for each configured language; those without samples say so."""
    spark = samples.sparkSession
    tokens = samples.withColumn("tokens", longest_matches(F.col("sample"), vocabulary))
    chars = F.array(*[F.lit(c) for c in sorted({c for t in vocabulary for c in t})])
    rows = metrics.sample_metrics(tokens, "tokens", "sample", chars)
    wanted = spark.createDataFrame([(x,) for x in languages], "language string")
    return metrics.validation(wanted, metrics.language_metrics(rows, "language", "tokens", threshold))
