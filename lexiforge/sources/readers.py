"""Text, count and sample sources. Every reader gives a DataFrame with only the columns it needs, so scans are pruned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiforge.functions.extract import auto_column, first_text, text_column
from lexiforge.functions.text import one_line, pystrip

COUNT_SCHEMA = T.StructType([T.StructField("seq", T.StringType()), T.StructField("count", T.LongType())])


def parquet_texts(spark: SparkSession, paths: str | list[str], preferred: list[str] | None = None) -> DataFrame:
    """(text) of non-empty rows; unreadable files are skipped."""
    df = spark.read.option("ignoreCorruptFiles", "true").parquet(*([paths] if isinstance(paths, str) else paths))
    name = text_column(df.schema, preferred or ["text", "content", "code", "sentence"])
    if name is None:
        raise ValueError("no string column")
    return df.select(F.col(f"`{name}`").alias("text")).where("text is not null and text <> ''")


def mixed_parquet_texts(spark: SparkSession, paths: list[str], preferred: list[str] | None = None) -> DataFrame:
    """Files of different schemas: one scan for each schema, united after projection."""
    groups: dict[str, list[str]] = {}
    for p in paths:
        groups.setdefault(spark.read.parquet(p).schema.json(), []).append(p)
    parts = [parquet_texts(spark, ps, preferred) for ps in groups.values()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, language) with blanks dropped."""
    df = spark.read.csv(path, header=True)
    if "file_path" not in df.columns:
        raise ValueError("the manifest has no file_path column")
    language = F.trim("language") if "language" in df.columns else F.lit(None).cast("string")
    return df.select(F.trim("file_path").alias("file_path"), language.alias("language")).where("file_path <> ''")


def counts(spark: SparkSession, paths: str | list[str], kind: str | None = None) -> DataFrame:
    """(seq, count) of JSON lines or tab-separated files, compressed or not.

    Malformed lines are skipped, and the file goes on; a JSON line without a count has 0. Only rows with a sequence and a positive count stay.
    """
    paths = [paths] if isinstance(paths, str) else paths
    kind = kind or ("tsv" if ".tsv" in paths[0] else "jsonl")
    lines = spark.read.text(paths)
    if kind == "tsv":
        cut = F.split("value", "\t")
        parsed = lines.where(F.size(cut) == 2).select(cut[0].alias("seq"), cut[1].try_cast("long").alias("count"))
    else:
        parsed = lines.select(F.from_json("value", COUNT_SCHEMA, {"mode": "PERMISSIVE"}).alias("r")).select("r.seq", F.coalesce("r.count", F.lit(0)).alias("count"))
    return parsed.where("seq is not null and seq <> '' and count > 0")


def malformed_counts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """How many JSON lines have no sequence or no whole count."""
    parsed = spark.read.text(paths).select(F.from_json("value", COUNT_SCHEMA).alias("r"))
    return parsed.agg(F.count_if(F.col("r.seq").isNull() | F.col("r").isNull()).alias("malformed"))


def count_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every counts_shard* file of a folder, in both formats."""
    parts = []
    for kind in ("jsonl", "tsv"):
        lines = spark.read.option("pathGlobFilter", f"counts_shard*.{kind}*")
        try:
            lines.text(folder).head(1)
        except Exception:  # a folder without files of this kind
            continue
        parts.append(counts(spark, f"{folder}/counts_shard*.{kind}*", kind))
    if not parts:
        return spark.createDataFrame([], COUNT_SCHEMA)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def json_texts(spark: SparkSession, path: str, least: int = 11) -> DataFrame:
    """Text of JSON lines by R3; malformed lines and texts of fewer characters, stripped or not, are dropped."""
    df = spark.read.option("mode", "DROPMALFORMED").json(path)
    return df.select(first_text(df).alias("text")).where((F.length(pystrip(F.col("text"))) >= least) & (F.length("text") >= least))


def arrow_folders(spark: SparkSession, root: str) -> dict[str, str]:
    """Folders below ``root`` that hold a dataset in Arrow files: dataset_info.json, state.json and an .arrow file side by side.

    Each with its name as file metadata write it. A catalogue of folders.
    """
    folder = lambda c: F.regexp_extract(c, r"^(.*)/[^/]*$", 1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    names = files.select(folder("path").alias("folder"), folder("_metadata.file_path").alias("shown"), F.substring_index("path", "/", -1).alias("name"))
    marks = names.groupBy("folder", "shown").agg(F.count_if(F.col("name") == "dataset_info.json").alias("i"), F.count_if(F.col("name") == "state.json").alias("s"), F.count_if(F.col("name").endswith(".arrow")).alias("a"))
    return {r["folder"]: r["shown"] for r in marks.where("i > 0 and s > 0 and a > 0").collect()}


def tree_texts(spark: SparkSession, root: str) -> DataFrame:
    """All Parquet and JSON-lines files below a folder, and its Arrow datasets; other files inside those are theirs and not read."""
    folders, outside = arrow_folders(spark, root), F.lit(True)
    for shown in folders.values():
        outside = outside & ~F.col("_metadata.file_path").startswith(shown + "/")
    parts = []
    for kind in ("parquet", "jsonl"):
        scan = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{kind}")
        try:
            df = scan.parquet(root) if kind == "parquet" else scan.option("mode", "DROPMALFORMED").json(root)
        except Exception as x:
            if "UNABLE_TO_INFER_SCHEMA" in str(x) or "PATH_NOT_FOUND" in str(x):
                continue
            raise
        parts.append(df.where(outside).select(first_text(df).alias("text")).where("text is not null and text <> ''"))
    parts += [arrow_texts(spark, f"{f}/*.arrow") for f in folders]
    out = parts[0] if parts else spark.createDataFrame([], "text string")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def first_rows(spark: SparkSession, paths: str | list[str], most: int) -> DataFrame:
    """At most the first ``most`` rows of each Parquet file, by their place in it; no shuffle."""
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    return df.where(F.col("_metadata.row_index") < most).select(df.columns)


def first_rows_of_all(spark: SparkSession, path: str, most: int) -> DataFrame:
    """S10 on a table that may be a folder of many files: its first ``most`` rows in the order of file names and of rows in them."""
    df = spark.read.parquet(path)
    place = F.struct(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("file"), F.col("_metadata.row_index").alias("row"))
    # No file gives more than ``most`` rows, so the sort is of a few rows a file.
    return df.select("*", place.alias("_place")).where(F.col("_place.row") < most).orderBy("_place").limit(most).select(df.columns)


def arrow_texts(spark: SparkSession, paths: str | list[str], column: str = "text") -> DataFrame:
    """Texts of over 10 characters from Arrow IPC files, a file for each row of the scan."""
    return arrow_contents(spark.read.format("binaryFile").load(paths).select("content"), column)


def arrow_contents(files: DataFrame, column: str = "text") -> DataFrame:
    """S12 on a column of whole IPC files or streams; a value that is neither fails the task."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for content in batch.column(0):
                data = content.as_buffer()
                try:
                    reader = pa.ipc.open_file(data)
                    found = (reader.get_batch(k) for k in range(reader.num_record_batches))
                except pa.ArrowInvalid:
                    found = pa.ipc.open_stream(data)
                for b in found:
                    yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(column)).cast(pa.string())], names=["text"])

    return files.mapInArrow(run, "text string").where("length(text) > 10")


def arrow_files(rows: DataFrame, column: str = "text") -> DataFrame:
    """The texts as Arrow IPC files, one for each batch: (content binary)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_file(sink, batch.schema) as writer:
                writer.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["content"])

    return rows.select(F.col(column).alias("text")).mapInArrow(run, "content binary")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Stripped non-empty lines."""
    return spark.read.text(path).select(pystrip(F.col("value")).alias("text")).where("text <> ''")


def dataset_lines(df: DataFrame, field: str = "auto", least: int = 1) -> DataFrame:
    """One-line texts of a dataset of at least ``least`` characters."""
    name = auto_column(df.schema) if field == "auto" else field
    return df.select(one_line(F.col(f"`{name}`").cast("string")).alias("text")).where(F.length("text") >= max(1, least))


def labelled_samples(spark: SparkSession, path: str) -> DataFrame:
    """(language, sample) of "lang: text" lines."""
    raw = spark.read.text(path).where(F.instr("value", ":") > 0)
    return raw.select(F.trim(F.substring_index("value", ":", 1)).alias("language"), pystrip(F.regexp_extract("value", r"^[^:]*:(.*)$", 1)).alias("sample"))


def chunks_of(df: DataFrame, key: str, size: int = 1000) -> DataFrame:
    """Batch number of each row, in order of ``key``, without one task that sees all rows: numbers come from range-partition counts."""
    from lexiforge.storage import materialize

    parts = materialize(df.repartitionByRange(key).sortWithinPartitions(key).withColumn("_row", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_row", 33)
    sizes = {r["p"]: r["n"] for r in parts.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}  # one row a partition
    before, starts = 0, []
    for p in sorted(sizes):
        starts += [F.lit(p), F.lit(before)]
        before += sizes[p]
    if not starts:
        return df.withColumn("batch", F.lit(0).cast("long"))
    row = F.col("_row") - F.shiftleft(part, 33) + F.create_map(*starts)[part]
    return parts.withColumn("batch", F.floor(row / size)).drop("_row")
