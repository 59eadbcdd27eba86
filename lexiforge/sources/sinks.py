"""Sinks. Spark's commit protocol makes each write whole or absent."""

from __future__ import annotations

import json
import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.storage import new_path


def write_counts(counts: DataFrame, path: str, kind: str = "jsonl", compression: str = "gzip") -> None:
    """(seq, count) sorted by sequence over the whole output; an empty table gives a valid empty output."""
    rows = counts.select("seq", "count").orderBy("seq")
    if kind == "tsv":
        rows.write.option("sep", "\t").option("quote", "").option("compression", compression).csv(path)
    else:
        rows.write.option("compression", compression).json(path)


def write_named(rows: DataFrame, folder: str, stem: str, suffix: str, write) -> list[str]:
    """Part files of ``write(writer, path)`` moved to ``folder`` as stem_0suffix, stem_1suffix, ...; the names."""
    spark = rows.sparkSession
    part = new_path(spark, "named")
    write(rows.write, part)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(part).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    found = sorted(s.getPath().toString() for s in fs.listStatus(path(part)) if s.getPath().getName().startswith("part-"))
    names = [f"{stem}_{k}{suffix}" for k in range(len(found))]
    for old, new in zip(found, names):
        if not fs.rename(path(old), path(f"{folder}/{new}")):
            raise OSError(f"{folder}/{new} is there already")
    fs.delete(path(part), True)
    return names


def write_count_shard(counts: DataFrame, folder: str, shard: int, kind: str = "jsonl") -> list[str]:
    """K01/K02 for one shard: files counts_shard<shard>_<k>.<kind>.gz in a folder that other shards write to as well."""
    rows = counts.select("seq", "count").sortWithinPartitions("seq")
    write = (lambda w, p: w.option("compression", "gzip").json(p)) if kind == "jsonl" else (lambda w, p: w.option("sep", "\t").option("quote", "").option("compression", "gzip").csv(p))
    return write_named(rows, folder, f"counts_shard{shard}", f".{kind}.gz", write)


def write_unread(manifest: DataFrame, read: DataFrame, path: str, most: int = 10_000) -> None:
    """Files of the manifest that were not read; a report of at most ``most`` names."""
    manifest.join(read.select("file_path"), "file_path", "left_anti").select("file_path").orderBy("file_path").limit(most).write.text(path)


def write_manifest(files: DataFrame, path: str) -> None:
    """K05."""
    files.select(F.col("path").alias("file_path"), "language").orderBy("file_path").write.option("header", "true").csv(path)


def write_texts(rows: DataFrame, path: str, text: str = "text") -> None:
    """K07."""
    rows.select(F.replace(F.col(text), F.lit("\n"), F.lit(" ")).alias("value")).write.text(path)


def write_column(rows: DataFrame, field: str, path: str, max_rows: int | None = None) -> None:
    """One string column as Parquet; ``max_rows`` is the feature's own limit."""
    out = rows.select(field).where(F.col(field).isNotNull())
    (out.limit(max_rows) if max_rows else out).write.option("compression", "zstd").parquet(path)


def write_token_frequencies(tokens: DataFrame, ids: DataFrame, path: str) -> None:
    """Token, id and count by falling count."""
    tokens.join(ids, "token").select("token", "id", "count").orderBy(F.desc("count"), "token").write.option("sep", "\t").csv(path)


def write_files(folder: str, contents: dict[str, str]) -> None:
    """Small driver-side files, each renamed into place when it is whole."""
    os.makedirs(folder, exist_ok=True)
    for name, text in contents.items():
        part = os.path.join(folder, f".{name}.part")
        with open(part, "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(part, os.path.join(folder, name))


def analysis_document(languages: DataFrame, files: DataFrame, **info) -> str:
    """The catalogue's statistics as one JSON document; the tables are catalogues of files and languages."""
    return json.dumps({**info, "language_statistics": [r.asDict() for r in languages.collect()], "file_mappings": {r["path"]: r["language"] for r in files.select("path", "language").toLocalIterator()}}, ensure_ascii=False, indent=1, default=str)


def json_rows(rows: DataFrame) -> DataFrame:
    """A JSON document for each row."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("document"))


def histogram(rows: DataFrame, group: str, value: str, width: float) -> DataFrame:
    """The table behind a plot: how many values of each group fall into each bin of ``width``."""
    return rows.groupBy(group, F.floor(F.col(value) / width).alias("bin")).agg(F.count("*").alias("n"))


def run_log(params: dict[str, str], metrics: DataFrame) -> DataFrame:
    """(kind, name, value) of a run's settings and of the columns of its one row of metrics, for any store of runs."""
    cells = F.array(*[F.struct(F.lit("metric").alias("kind"), F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("value")) for c in metrics.columns])
    given = metrics.sparkSession.createDataFrame([("param", k, str(v)) for k, v in params.items()], "kind string, name string, value string")
    return given.union(metrics.select(F.explode(cells).alias("x")).select("x.*"))


def embedding_table(spark: SparkSession, vocab: int, dim: int, seed: int = 42, scale: float = 0.02) -> DataFrame:
    """(id, vector) of normal numbers."""
    vector = F.array(*[F.randn(seed + k) * scale for k in range(dim)]).cast("array<float>")
    return spark.range(vocab).select("id", vector.alias("vector"))


def embedding_matrix(vocab: int, dim: int, seed: int = 42, scale: float = 0.02) -> np.ndarray:
    """K15 as a .npy-ready matrix."""
    return (np.random.default_rng(seed).standard_normal((vocab, dim)) * scale).astype(np.float32)


def write_results(metrics: DataFrame, path: str, kind: str = "json") -> None:
    """Validation results as JSON lines or CSV."""
    writer = metrics.write
    writer.option("header", "true").csv(path) if kind == "csv" else writer.json(path)


def markdown(metrics: DataFrame, title: str = "Tokenizer validation") -> str:
    """A table of the per-language results, a row for each language."""
    rows, cols = metrics.collect(), metrics.columns
    show = lambda v: "" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v)
    out = [f"# {title}", "", "| " + " | ".join(cols) + " |", "|" + "---|" * len(cols)]
    return "\n".join(out + ["| " + " | ".join(show(r[c]) for c in cols) + " |" for r in rows]) + "\n"


def html(metrics: DataFrame, title: str = "Tokenizer validation") -> str:
    """The same as a page; plots are left to whoever reads the tables."""
    from html import escape

    rows, cols = metrics.collect(), metrics.columns
    cells = lambda tag, xs: "<tr>" + "".join(f"<{tag}>{escape(str(x))}</{tag}>" for x in xs) + "</tr>"
    return f"<!doctype html><title>{escape(title)}</title><h1>{escape(title)}</h1><table>{cells('th', cols)}{''.join(cells('td', r) for r in rows)}</table>\n"
