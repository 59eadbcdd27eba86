"""File catalogues: listing, integrity, size, profile, manifest."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.functions.text import filename_parts, pystrip
from lexiforge.operators.metrics import null_profile


def listing(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """(path, size_bytes, dataset, file_number) of files; contents are not read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(root)
    dataset, number = filename_parts(F.col("path"))
    return df.select("path", F.col("length").alias("size_bytes"), dataset.alias("dataset"), number.alias("file_number"))


def size_gb(files: DataFrame) -> DataFrame:
    """Files once each, in GiB."""
    return files.agg(F.count("*").alias("files"), (F.coalesce(F.sum("size_bytes"), F.lit(0)) / 1024**3).alias("gb"))


def integrity(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, rows, status done | corrupt | missing) of Parquet files; nothing is renamed."""
    rows = []
    for path in paths:
        try:
            n = spark.read.parquet(path).count()
            rows.append((path, n, "done" if n else "corrupt"))
        except Exception as x:
            rows.append((path, None, "missing" if "PATH_NOT_FOUND" in str(x) else "corrupt"))
    return spark.createDataFrame(rows, "path string, rows long, status string")


def quarantined(spark: SparkSession, found: DataFrame, rename: bool = False, suffix: str = ".corrupted") -> DataFrame:
    """The corrupt files of ``integrity`` with their names to be; with ``rename`` they get these names. A catalogue of files."""
    bad = found.where("status = 'corrupt'").select("path", F.concat("path", F.lit(suffix)).alias("renamed"))
    for r in bad.collect() if rename else ():
        old, new = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in r)
        if not old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, new):
            raise OSError(f"could not rename {r['path']}")
    return bad


def record_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, records) of Parquet datasets, from their footers, with a last row of path null for all together."""
    total = lambda p: spark.read.parquet(p).agg(F.count("*").alias("records")).select(F.lit(p).alias("path"), "records")
    each = total(paths[0])
    for p in paths[1:]:
        each = each.union(total(p))
    return each.union(each.agg(F.sum("records").alias("records")).select(F.lit(None).cast("string").alias("path"), "records"))


def mapped_files(files: DataFrame, mapping: DataFrame, key: str = "path") -> DataFrame:
    """Files that have a language, with it."""
    return files.join(mapping, key)


def first_urls(manifest: DataFrame, name: str = "file_name", url: str = "url", order: str = "ord") -> DataFrame:
    """For each file name the URL that stands first in the manifest."""
    return manifest.groupBy(name).agg(F.min_by(url, order).alias(url))


def size_ok(actual, expected):
    """S28 on columns: within a tenth, or 1 KiB if that is more."""
    return F.abs(actual - expected) <= F.greatest(F.lit(1024), F.floor(expected / 10))


def path_id(path):
    """N16 on a column: an id for inside use, from SHA-256; ``digest64`` gives the reference's."""
    return F.substring(F.sha2(path, 256), 1, 16)


def size_accepted(actual: int, expected: int) -> bool:
    """Within a tenth, or 1 KiB if that is more."""
    return abs(actual - expected) <= max(1024, expected // 10)


def profile(spark: SparkSession, path: str, preview: int = 10) -> tuple[DataFrame, DataFrame]:
    """(null profile, first rows)."""
    df = spark.read.parquet(path)
    return null_profile(df), df.limit(preview)


def micro_sample(rows: DataFrame, file: str, order: str, text: str, most_rows: int = 128, most_chars: int = 8192) -> DataFrame:
    """(file, content): the first non-empty rows of each file, joined by newlines and cut."""
    from pyspark.sql import Window as W

    ranked = rows.select(file, order, pystrip(F.col(text)).alias("_t")).withColumn("_rn", F.row_number().over(W.partitionBy(file).orderBy(order))).where(F.col("_rn") <= most_rows)
    before = F.coalesce(F.sum(F.length("_t")).over(W.partitionBy(file).orderBy("_rn").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    kept = ranked.where("_t <> ''").withColumn("_before", before).where(F.col("_before") < most_chars)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "_t"))), lambda x: x["_t"]), "\n")
    return kept.groupBy(file).agg(F.substring(joined, 1, most_chars).alias("content"))


def union_mappings(top: DataFrame, selected: DataFrame, key: str = "path", value: str = "language") -> DataFrame:
    """Both mappings, that of ``top`` where both have a key."""
    a, b = top.select(key, F.col(value).alias("_a")), selected.select(key, F.col(value).alias("_b"))
    return a.join(b, key, "full").select(key, F.coalesce("_a", "_b").alias(value))


def manifest_digest(manifest: DataFrame) -> str:
    """blake2b-128 over "path:language" in path order; a catalogue of files, streamed to the driver."""
    h = hashlib.blake2b(digest_size=16)
    for r in manifest.orderBy("file_path").select("file_path", "language").toLocalIterator():
        h.update(f"{r[0]}:{r[1]}".encode())
    return h.hexdigest()


def manifest_md5(manifest: DataFrame) -> DataFrame:
    """K05 as a query: md5 of the same string, made of a catalogue of files."""
    lines = F.array_sort(F.collect_list(F.struct("file_path", "language")))
    return manifest.agg(F.md5(F.array_join(F.transform(lines, lambda x: F.concat(x["file_path"], F.lit(":"), x["language"])), "")).alias("digest"))


def digest64(text: str) -> str:
    """N16."""
    return hashlib.blake2b(text.encode(), digest_size=8).hexdigest()
