"""Arrow datasets, quarantine, resumed training, batches and matching, against plain Python."""

import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexiforge.operators import sampling
from lexiforge.plans import bpe, encode, resume
from lexiforge.sources import catalog, readers, sinks


def arrow_folder(folder, texts, whole=True):
    os.makedirs(folder)
    table = pa.table({"text": texts})
    with pa.OSFile(f"{folder}/data-00000-of-00001.arrow", "wb") as out, pa.ipc.new_stream(out, table.schema) as w:
        w.write_table(table)
    for name in ("dataset_info.json", "state.json")[: 2 if whole else 1]:
        with open(f"{folder}/{name}", "w") as f:
            f.write("{}")


def test_tree_with_arrow_datasets(spark, tmp_path):
    root = f"{tmp_path}/tree (1)"
    arrow_folder(f"{root}/set", ["a text in an Arrow file", "short", None])
    arrow_folder(f"{root}/part", ["no dataset: a file is missing"], whole=False)
    spark.createDataFrame([("inside the dataset, not read",)], "text string").write.parquet(f"file://{root}/set/extra")
    spark.createDataFrame([("p",), ("",)], "text string").write.parquet(f"file://{root}/plain")
    sinks.write_named(spark.createDataFrame([("j",)], "text string"), f"file://{root}/lines", "rows", ".jsonl", lambda w, p: w.json(p))
    # Files below a dataset's folder are the dataset's; its Parquet files are no source of their own.
    got = sorted(r.text for r in readers.tree_texts(spark, f"file://{root}").collect())
    assert got == ["a text in an Arrow file", "j", "p"]


def test_first_rows_of_each_file(spark, tmp_path):
    for k in range(2):
        spark.range(10 * k, 10 * k + 5).coalesce(1).write.parquet(f"file://{tmp_path}/f/{k}")
    got = readers.first_rows(spark, [f"file://{tmp_path}/f/0", f"file://{tmp_path}/f/1"], 2)
    assert sorted(r.id for r in got.collect()) == [0, 1, 10, 11] and got.columns == ["id"]


def test_quarantine(spark, tmp_path):
    with open(f"{tmp_path}/bad.parquet", "wb") as f:
        f.write(b"no parquet")
    path = f"file://{tmp_path}/bad.parquet"
    bad = catalog.quarantined(spark, catalog.integrity(spark, [path]), rename=True)
    assert [tuple(r) for r in bad.collect()] == [(path, path + ".corrupted")]
    assert os.listdir(tmp_path) == ["bad.parquet.corrupted"] or not os.path.exists(f"{tmp_path}/bad.parquet")


@pytest.mark.parametrize("mode", ["iterative", "single_pass"])
def test_training_goes_on_after_a_loss(spark, tmp_path, mode):
    rng = random.Random(3)
    rows = [([ord(c) for c in "".join(rng.choice("abcdef") for _ in range(rng.randrange(2, 30)))], rng.randrange(1, 5)) for _ in range(80)]
    seqs = spark.createDataFrame(rows, "seq array<int>, count long")
    whole = bpe.train(seqs, 40, batch_merges=3, mode=mode)
    folder = f"file://{tmp_path}/rounds"
    bpe.train(seqs, 40, batch_merges=3, mode=mode, max_rounds=2, folder=folder)
    assert resume.rounds(spark, folder) == [0, 1]
    again = bpe.train(seqs, 40, batch_merges=3, mode=mode, folder=folder)
    assert (again.merges, again.tokens, again.stopped) == (whole.merges, whole.tokens, whole.stopped)


def test_batches_train_like_all_their_words(spark, tmp_path):
    words = spark.createDataFrame([("abab", 3), ("abc", 2), ("bc", 4)], "token string, count long")
    folder = f"file://{tmp_path}/b"
    for name, part in (("x", words.where("token <> 'bc'")), ("y", words.where("token = 'bc'")), ("x", words)):
        bpe.add_batch(folder, name, part)
    assert bpe.train_words(bpe.batch_counts(spark, folder), 8) == bpe.train_words(words, 8)


def slow_merge(symbols, ranks):
    while True:
        at = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not at:
            return symbols
        _, i = min(at)
        symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2 :]]


def test_merging_a_word():
    rng = random.Random(5)
    for _ in range(300):
        pool, merges = list("abc"), []
        for _ in range(rng.randrange(1, 12)):
            merges.append((rng.choice(pool), rng.choice(pool)))
            pool.append("".join(merges[-1]))
        ranks = {m: k for k, m in enumerate(merges)}
        word = [rng.choice("abc") for _ in range(rng.randrange(0, 20))]
        assert encode.merge_word(word, ranks) == slow_merge(word, ranks)


def test_longest_matches_of_large_vocabularies(spark):
    rng = random.Random(6)
    vocabulary = sorted({"".join(rng.choice("ab.+\\E\n") for _ in range(rng.randrange(1, 6))) for _ in range(900)})
    texts = [(k, "".join(rng.choice("abc.+\\E\n") for _ in range(60))) for k in range(40)] + [(40, ""), (41, None)]
    df = spark.createDataFrame(texts, "k long, t string")
    few = [w for w in vocabulary if len(w) < 5][:400]
    limit, encode.EXPRESSION_WORDS = encode.EXPRESSION_WORDS, 0
    slow = df.select("k", encode.longest_matches(F.col("t"), few).alias("m")).collect()
    encode.EXPRESSION_WORDS = limit
    fast = df.select("k", encode.longest_matches(F.col("t"), few).alias("m")).collect()
    assert len(vocabulary) > limit >= len(few) and sorted(slow) == sorted(fast) and sum(len(r.m) for r in fast) > 400


def test_rules_of_thumb():
    assert [sampling.chunk_size(8000, u) for u in (0.5, 0.85, 0.95)] == [8000, 4000, 2000] and sampling.chunk_size(2000, 0.95) == 1000


def test_pairs_of_wide_characters(spark):
    from collections import Counter

    from lexiforge.operators import counts

    texts = ["a😀é😀\n😀", "😀", "", None, "日本퟿x", "aaa", "😀😀😀"]
    got = {(chr(r.a), chr(r.b)): r.cnt for r in counts.weighted_pairs(spark.createDataFrame([(t, 2) for t in texts], "text string, count long")).collect()}
    assert got == {k: 2 * v for k, v in Counter(p for t in texts if t for p in zip(t, t[1:])).items()}
    got = {(chr(r.a), chr(r.b)): r.df for r in counts.document_pairs(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    assert got == Counter(p for t in texts if t for p in set(zip(t, t[1:])))
