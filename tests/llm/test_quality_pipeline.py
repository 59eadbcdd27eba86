"""Held-out accuracy of the classifier, and the pipeline stage by stage against plain Python."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

import corpus_pipeline
from lexiforge.llm import quality


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality.scored(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for k, r in got.items())
    pairs = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(pairs) > 40 and np.mean([a == b for a, b in pairs]) > 0.95
    assert all(a for a, b in pairs if b == 1)  # clean documents stay


def test_scores_do_not_depend_on_the_batch():
    encode = quality.PassageEncoder()
    texts = [b"", b"one", b"A b c. " * 100, "é À b!\n".encode() * 77, b"x" * 3_000_000, b"word " * 700_000]
    together = encode(texts)
    for t, x in zip(texts, together):
        assert np.array_equal(x, encode([t])[0])
    assert len(together[0]) == 1 and len(together[2]) == 7 and len(together[5]) >= 700_000 // 48


def test_gradients():
    rng = np.random.default_rng(0)
    model = quality.AttentionModel(5, 4, 3)
    bags, y = [rng.standard_normal((n, 5)) for n in (1, 4, 7)], np.array([1.0, 0.0, 1.0])
    x, starts = np.concatenate(bags), np.array([0, 1, 5])
    before = -np.mean(np.log(np.where(y == 1, model.score(x, starts), 1 - model.score(x, starts))))
    model.fit(bags, y, epochs=400)
    after = -np.mean(np.log(np.where(y == 1, model.score(x, starts), 1 - model.score(x, starts))))
    assert after < before / 10


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """A small corpus with junk, exact and near copies and personal data, and what is in it."""
    rng, root = random.Random(8), tmp_path_factory.mktemp("world")
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(900)]

    def prose(n):
        words = [rng.choice(vocabulary) for _ in range(n)]
        return " ".join(w.capitalize() + "." if k % 9 == 8 else w for k, w in enumerate(words))

    texts, kind = [], []
    for k in range(240):
        what = rng.choice(["clean"] * 5 + ["junk", "copy", "near", "private"])
        if what in ("copy", "near") and not any(x == "clean" for x in kind):
            what = "clean"
        if what == "junk":
            t = " ".join(w.upper() + "!!" for w in prose(200).split())
        elif what in ("copy", "near"):
            t = texts[rng.choice([i for i, x in enumerate(kind) if x == "clean"])]
            if what == "near":
                w = t.split()
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
                t = " ".join(w)
        else:
            t = prose(220) + (" Mail jo.do@mail1.example.com or 4078918989542222." if what == "private" else "")
        texts.append(t)
        kind.append(what)
    spark.createDataFrame([(k, t, "en", f"src{k % 3}", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(k, int(x != "junk"), 0) for k, x in enumerate(kind) if k % 2 == 0], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root), texts, kind


def test_stages(spark, world):
    root, texts, kind = world
    docs = spark.read.parquet(f"{root}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "SimHash near-dedup", "PII", "packing"]
    stages, columns = dict(corpus_pipeline.STAGES), docs.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    docs = stages["quality classifier"](spark, docs, root).cache()
    assert docs.columns == columns and ids(docs) == [k for k, x in enumerate(kind) if x != "junk"]
    docs = stages["exact dedup"](spark, docs, root).cache()
    first = {}
    for k in (k for k, x in enumerate(kind) if x != "junk"):
        first.setdefault(texts[k], k)
    assert docs.columns == columns and ids(docs) == sorted(first.values())
    docs = stages["SimHash near-dedup"](spark, docs, root).cache()
    assert docs.columns == columns and ids(docs) == [k for k in sorted(first.values()) if kind[k] != "near"]
    before = {r.doc_id: r.text for r in docs.collect()}
    docs = stages["PII"](spark, docs, root).cache()
    assert docs.columns == columns
    for r in docs.collect():
        assert (r.text == before[r.doc_id]) == (kind[r.doc_id] != "private") and r.n_chars == len(r.text)
        assert "4078918989542222" not in r.text and "jo.do@" not in r.text
    after = {r.doc_id: r.text for r in docs.collect()}
    pieces = stages["packing"](spark, docs, root).collect()
    from tokenizers import Tokenizer

    count = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    total = {k: len(count.encode(t, add_special_tokens=False).ids) + 1 for k, t in after.items()}
    got = {}
    for p in pieces:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
    assert got == total


def test_run_is_the_stages(spark, world):
    root, texts, kind = world
    rows = corpus_pipeline.run(spark, root).collect()
    assert {r.doc_id for r in rows} <= {k for k, x in enumerate(kind) if x not in ("junk", "near")}
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
