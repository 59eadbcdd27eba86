"""Registered training queries over the whole documents table against plain Python."""

import os
import random
from collections import Counter

import duckdb

from lexiforge.plans import bpe
from lexiforge.queries import ORACLE_SQL, QUERIES
from test_training import slow_picky


def test_picky_reads_all_documents(spark, tmp_path):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(2, 60))) for _ in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, "xyxyxy")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [tuple(r) for r in QUERIES["B05_picky"](spark, str(tmp_path)).collect()]
    assert got == slow_picky([[ord(c) for c in t] for t in texts], 12, 0.9, "as_is")


def test_more_words_than_the_driver_takes(spark):
    rng = random.Random(7)
    words = Counter("".join(rng.choice("aab") for _ in range(rng.randrange(1, 7))) for _ in range(120))
    words = spark.createDataFrame(list(words.items()), "token string, count long")
    want = bpe.train_words(words, 16, specials=["<pad>"])
    assert len(want[1]) > 10 and bpe.train_all_words(words, 16, specials=["<pad>"], driver_limit=5) == want


def same_as_sql(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    got = QUERIES[name](spark, str(folder))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want)) and want
    return want


def test_codepoints_of_odd_texts(spark, tmp_path):
    texts = ["", None, "\0a", "e\u0301😀", " ", "a\n"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    same_as_sql(spark, tmp_path, "N05_codepoints")


def test_first_rows_of_a_table_of_many_files(spark, tmp_path):
    os.makedirs(f"{tmp_path}/documents.parquet")
    for k, name in enumerate(["b", "a +", "a %2B", "c", "a"]):
        duckdb.sql(f"COPY (SELECT (1000 * {k} + i)::BIGINT AS doc_id, 'x' AS text FROM range(40) t(i)) TO '{tmp_path}/documents.parquet/{name}.parquet'")
    assert len(same_as_sql(spark, tmp_path, "S10_first_rows")) == 100
