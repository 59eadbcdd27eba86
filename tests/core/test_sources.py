"""Readers, catalogue, sinks, resume, streaming and end-to-end plans on temporary files."""

import gzip
import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexiforge.functions.text import sequence_key
from lexiforge.operators import counts
from lexiforge.plans import corpus, resume
from lexiforge.sources import catalog, readers, registry, sinks
from lexiforge.streaming import counting


def write(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = content.encode() if isinstance(content, str) else content
    with open(path, "wb") as f:
        f.write(data)
    return f"file://{path}"


def test_parquet_texts_of_mixed_schemas(spark, tmp_path):
    a, b = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    spark.createDataFrame([(1, "x"), (2, ""), (3, None)], "id int, text string").write.parquet(a)
    spark.createDataFrame([("y", 1)], "sentence string, n int").write.parquet(b)
    assert sorted(r.text for r in readers.mixed_parquet_texts(spark, [a, b]).collect()) == ["x", "y"]
    with pytest.raises(ValueError):
        spark.range(3).write.parquet(f"file://{tmp_path}/c")
        readers.parquet_texts(spark, f"file://{tmp_path}/c")


def test_count_files(spark, tmp_path):
    lines = ['{"seq": "97 98", "count": 3}', "broken", '{"count": 4}', '{"seq": "99"}', '{"seq": "100", "count": 1}']
    p = write(f"{tmp_path}/counts_shard0.jsonl.gz", gzip.compress("\n".join(lines).encode()))
    q = write(f"{tmp_path}/counts_shard1.tsv", "97 98\t5\nbad line\n101\tx\n102\t2\n")
    write(f"{tmp_path}/other.jsonl", '{"seq": "1", "count": 1}')
    assert sorted(map(tuple, readers.counts(spark, p).collect())) == [("100", 1), ("97 98", 3)]
    assert sorted(map(tuple, readers.counts(spark, q).collect())) == [("102", 2), ("97 98", 5)]
    assert readers.malformed_counts(spark, p).first().malformed == 2
    merged = counts.merged_counts(readers.count_files(spark, f"file://{tmp_path}"))
    assert sorted(map(tuple, merged.collect())) == [("100", 1), ("102", 2), ("97 98", 8)]
    sinks.write_counts(merged, f"file://{tmp_path}/out")
    assert [r.seq for r in readers.counts(spark, f"file://{tmp_path}/out", "jsonl").orderBy("seq").collect()] == ["100", "102", "97 98"]
    sinks.write_counts(merged.where("false"), f"file://{tmp_path}/empty", "tsv")
    assert readers.counts(spark, f"file://{tmp_path}/empty", "tsv").collect() == []


def test_lines_samples_and_json(spark, tmp_path):
    p = write(f"{tmp_path}/s.txt", "sv: Hej: du\nno: Hei \n\nplain\n")
    assert sorted(map(tuple, readers.labelled_samples(spark, p).collect())) == [("no", "Hei"), ("sv", "Hej: du")]
    assert len(readers.lines(spark, p).collect()) == 3
    rows = [{"text": "a text that is long"}, {"content": "from the content field"}, {"text": "short"}, {"text": None, "body": "a body of some length"}]
    q = write(f"{tmp_path}/t/x.jsonl", "\n".join(map(json.dumps, rows)) + "\nnot json\n")
    assert len(readers.json_texts(spark, q).collect()) == 3
    spark.createDataFrame([("p",)], "text string").write.parquet(f"file://{tmp_path}/t/sub/p.parquet")
    assert len(readers.tree_texts(spark, f"file://{tmp_path}/t").collect()) == 5
    df = spark.createDataFrame([(" a\nb ",), ("",)], "code string")
    assert [r.text for r in readers.dataset_lines(df).collect()] == ["a b"]


def test_arrow_files(spark, tmp_path):
    import pyarrow as pa

    table = pa.table({"text": ["one text that is long", "short", None]})
    with pa.OSFile(f"{tmp_path}/f.arrow", "wb") as out, pa.ipc.new_file(out, table.schema) as w:
        w.write_table(table)
    with pa.OSFile(f"{tmp_path}/s.arrow", "wb") as out, pa.ipc.new_stream(out, table.schema) as w:
        w.write_table(table)
    assert [r.text for r in readers.arrow_texts(spark, [f"{tmp_path}/f.arrow", f"{tmp_path}/s.arrow"]).collect()] == ["one text that is long"] * 2


def test_batches(spark):
    got = {r.k: r.batch for r in readers.chunks_of(spark.range(2500).select(F.col("id").alias("k")).repartition(7), "k", 1000).collect()}
    assert got == {k: k // 1000 for k in range(2500)}
    assert readers.chunks_of(spark.range(0).select(F.col("id").alias("k")), "k").collect() == []


def test_catalogue(spark, tmp_path):
    good, bad = f"file://{tmp_path}/d/a_b_01.parquet", write(f"{tmp_path}/d/broken.parquet", "no parquet")
    spark.range(5).write.parquet(good)
    status = {os.path.basename(r.path): (r.rows, r.status) for r in catalog.integrity(spark, [good, bad, f"file://{tmp_path}/none.parquet"]).collect()}
    assert status == {"a_b_01.parquet": (5, "done"), "broken.parquet": (None, "corrupt"), "none.parquet": (None, "missing")}
    files = catalog.listing(spark, f"file://{tmp_path}/d", "broken*")
    assert files.first().size_bytes == 10 and catalog.size_gb(files).first().files == 1
    nulls, rows = catalog.profile(spark, good)
    assert tuple(nulls.first()) == ("id", "bigint", 5, 0) and rows.count() == 5
    assert catalog.size_accepted(100, 900) and catalog.size_accepted(95_000, 100_000) and not catalog.size_accepted(80_000, 100_000)
    named = spark.createDataFrame([("b", "sv"), ("a", "en")], "path string, language string")
    sinks.write_manifest(named, f"file://{tmp_path}/m")
    back = readers.manifest(spark, f"file://{tmp_path}/m")
    assert sorted(map(tuple, back.collect())) == [("a", "en"), ("b", "sv")]
    import hashlib

    assert catalog.manifest_digest(back) == hashlib.blake2b(b"a:enb:sv", digest_size=16).hexdigest()
    assert len(catalog.digest64("x")) == 16
    sinks.write_unread(back, back.where("file_path = 'a'"), f"file://{tmp_path}/unread")
    assert [r.value for r in spark.read.text(f"file://{tmp_path}/unread").collect()] == ["b"]


def test_registry(spark):
    reg = registry.registry(spark, [("b", "text", None, 2), ("a", "text", ["sv", "fi"], 1), ("c", "text", [], 3)])
    assert [r.dataset_id for r in registry.selection(reg).collect()] == ["a:fi", "a:sv", "b", "c"]
    done = spark.createDataFrame([("a:fi",)], "dataset_id string")
    assert [r.dataset_id for r in registry.selection(reg, ["a", "b"], 2, done).collect()] == ["a:sv", "b"]
    assert [r.dataset for r in registry.allowed(reg, ["a", "c"]).orderBy("dataset").collect()] == ["a", "c"]
    assert registry.shard_index(3) == 3 and registry.shard_index(env=("NO_SUCH_NAME",)) == 0
    with pytest.raises(ValueError):
        registry.ValidationConfig.load({"languages": ["sv"]})
    assert registry.ValidationConfig.load({"tokenizer": "t", "languages": ["sv"], "retries": 3}).extra == {"retries": 3}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", 1), (None, 2)], "text string, n int")
    sinks.write_column(df, "text", f"file://{tmp_path}/col")
    assert spark.read.parquet(f"file://{tmp_path}/col").columns == ["text"]
    sinks.write_texts(df.where("text is not null"), f"file://{tmp_path}/txt")
    assert [r.value for r in spark.read.text(f"file://{tmp_path}/txt").collect()] == ["a b"]
    assert sinks.embedding_table(spark, 4, 3).count() == 4 and sinks.embedding_matrix(4, 3).shape == (4, 3)
    sinks.write_files(f"{tmp_path}/files", {"x.json": "{}"})
    assert os.listdir(f"{tmp_path}/files") == ["x.json"]
    m = spark.createDataFrame([("sv", 0.5)], "language string, ratio double")
    assert "| sv | 0.5000 |" in sinks.markdown(m) and "<td>sv</td>" in sinks.html(m)
    sinks.write_results(m, f"file://{tmp_path}/csv", "csv")
    assert spark.read.csv(f"file://{tmp_path}/csv", header=True).count() == 1
    files = spark.createDataFrame([("p", "sv")], "path string, language string")
    assert json.loads(sinks.analysis_document(m, files, version=1))["file_mappings"] == {"p": "sv"}
    freq, ids = spark.createDataFrame([("a", 2)], "token string, count long"), spark.createDataFrame([("a", 0)], "token string, id long")
    sinks.write_token_frequencies(freq, ids, f"file://{tmp_path}/freq")
    assert spark.read.text(f"file://{tmp_path}/freq").first().value == "a\t0\t2"


def test_resume(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.range(3)
    for _ in range(2):
        assert resume.once(spark, f"file://{tmp_path}/o", make).count() == 3
    assert made == [1]
    p = f"file://{tmp_path}/progress"
    assert resume.progress(spark, p).collect() == []
    resume.record(spark, p, "a", "failed", 0, 1)
    resume.record(spark, p, "a", "done", 5, 2)
    assert [tuple(r) for r in resume.progress(spark, p).collect()] == [("a", "done", 5)]
    f = f"file://{tmp_path}/rounds"
    assert resume.latest(spark, f) is None
    for n in (0, 1):
        resume.save_round(spark, f, n, spark.range(n + 1), {"n": n})
    spark.range(9).write.parquet(f"{f}/round=2/sequences")  # broken off before its state
    number, seqs, state = resume.latest(spark, f)
    assert (number, seqs.count(), state) == (1, 2, {"n": 1})


def test_streaming_counts(spark, tmp_path):
    src, target, check = (f"file://{tmp_path}/{x}" for x in ("src", "target", "check"))
    schema = spark.createDataFrame([], "text string").schema
    total = Counter()
    for batch in (["a", "b", " a "], ["a", ""]):
        spark.createDataFrame([(t,) for t in batch], schema).write.mode("append").parquet(src)
        total.update(t.strip() for t in batch if t.strip())
        counting.partial_counts(counting.arriving_texts(spark, src, schema), target, check).awaitTermination()
        assert {r.text: r["count"] for r in counting.merged(spark, target).collect()} == total
    q = counting.running_counts(counting.arriving_texts(spark, src, schema), "running", f"{check}2")
    q.awaitTermination()
    assert {r.text: r["count"] for r in spark.table("running").collect()} == total


def test_end_to_end(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seqs = corpus.counted(spark, [f"{sf}/documents.parquet"], f"file://{tmp_path}/counts")
    want = counts.text_counts(docs).select(sequence_key(F.col("text")).alias("seq"), "count")
    assert seqs.exceptAll(want).count() == 0 and want.exceptAll(seqs).count() == 0
    done = corpus.trained(seqs, f"{tmp_path}/tok", ("<pad>", "<unk>"), vocab_size=200, batch_merges=20)
    vocab = json.load(open(f"{tmp_path}/tok/vocab.json"))
    assert vocab["<pad>"] == 0 and set(done.tokens.values()) <= set(vocab) and done.merges
    samples = docs.select(F.col("lang").alias("language"), F.col("text").alias("sample"))
    report = {r.language: r for r in corpus.validated(samples, ["en", "fr", "xx"], list(vocab)).collect()}
    assert report["xx"].status == "error" and report["en"].status == "ok" and report["en"].mean_coverage == 1.0
    found = {r.source: r for r in corpus.profiled(docs, "source", "doc_id").collect()}
    assert all(r.usable_ratio == 1.0 for r in found.values())
