"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import public_tokenizers
import pytest

from lexiforge.llm import bpe, exact_dedup, media, packing, pii, quality, secrets, simhash, substring, urls

LONG = "lorem ipsum dolor sit amet " * 8000
ROWS = [
    (1, "The same text here", "a"), (2, "the SAME text here", "b"), (2, "the SAME text here", "b"), (3, None, None), (4, "", "c"),
    (None, "no id at all", "d"), (5, LONG, "e"), (6, LONG, "e"), (7, "x" * 200_000, "f"), (8, "é " * 60 + "\n\n\t", None),
]
COLUMNS = "doc_id long, text string, t string"
CLASHING = ["id", "fp", "rep", "row", "best", "sha", "size", "check", "run", "u", "v", "component_id", "keep_id", "score", "_t", "_m", "spans", "path", "blob", "th", "label"]
JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, COLUMNS)
    return df.withColumns({c: F.lit(f"clash {c}") for c in CLASHING})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, None, None), (None, 1, 0), (6, 1, 0), (7, 0, 1), (8, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "simhash": lambda d, labels: simhash.near_duplicates(d),
    "exact": lambda d, labels: exact_dedup.exact_groups(d),
    "secrets": lambda d, labels: secrets.span_digests(d),
    "substring": lambda d, labels: substring.without_repeats(d),
    "quality": lambda d, labels: quality.scored(d, labels),
    "bpe": lambda d, labels: bpe.round_trip(d, RANKS, public_tokenizers.PATTERN),
    "pii": lambda d, labels: pii.report(d),
    "media": lambda d, labels: media.stored_texts(d),
    "urls": lambda d, labels: urls.filtered_urls(d, "doc_id", "text"),
    "packing": lambda d, labels: packing.packed(d, JSON),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(name, docs, labels):
    got = OPERATORS[name](docs, labels).collect()
    if name == "packing":
        assert {r.doc_id for r in got} == {r[0] for r in ROWS}
    else:
        assert len(got) == len(ROWS)
        key = "page_id" if name == "urls" else "doc_id"
        assert sorted(str(r[key]) for r in got) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, docs, labels):
    assert OPERATORS[name](docs.where("false"), labels).collect() == []


def test_no_labels(docs, labels):
    assert {r.score for r in quality.scored(docs, labels.where("false")).collect()} == {1.0}
    assert {r.score for r in quality.scored(docs, labels.where("quality = 1")).collect()} == {1.0}


FILTERS = {
    "exact": lambda d, labels: exact_dedup.drop_exact_copies(d),
    "simhash": lambda d, labels: simhash.keep_one_of_each_group(d),
    "quality": lambda d, labels: quality.accepted(d, labels),
}


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_columns(name, docs, labels):
    out = FILTERS[name](docs, labels)
    assert out.columns == docs.columns
    rows = out.collect()
    assert 0 < len(rows) <= len(ROWS)
    assert all(r["id"] == "clash id" and r["_t"] == "clash _t" for r in rows)
    assert FILTERS[name](docs.where("false"), labels).collect() == []


def stage(name):
    import corpus_pipeline

    return dict(corpus_pipeline.STAGES)[name]


def test_ledger_edges(spark, docs, labels, tmp_path):
    ledger = f"file://{tmp_path}/ledger"
    runs = [sorted(map(str, secrets.scan_secrets(docs, ledger_path=ledger).collect())) for _ in range(2)]
    assert runs[0] == runs[1] == sorted(map(str, secrets.scan_secrets(docs).collect())) and len(runs[0]) == len(ROWS)
    assert secrets.scan_secrets(docs.where("false"), ledger_path=ledger).collect() == []


def test_encoded_and_sniffed_edges(docs):
    rows = bpe.encoded(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ROWS) and all(r.ids == [] and bytes(r.decoded) == b"" for r in rows if r.doc_id in (3, 4))
    assert bpe.encoded(docs.where("false"), RANKS, public_tokenizers.PATTERN).collect() == []
    got = media.sniffed(docs, "doc_id", "text").collect()
    assert len(got) == len(ROWS) and all(r.media_type is None for r in got if r.id in (3, 4)) and media.sniffed(docs.where("false"), "doc_id", "text").collect() == []


def test_largest_id_among_nulls(spark):
    rows = [(None, "a"), (3, "A"), (1, "a"), (None, "b"), (None, "B")]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), keep="largest").collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.kept) for r in got if r.group_size == 3) == [("1", "3", False), ("3", "3", True), ("None", "3", False)]
    assert [r.keep_id for r in got if r.group_size == 2] == [None, None] and sum(r.kept for r in got if r.group_size == 2) == 1


def test_a_class_without_ids_links_others(spark):
    """Three texts in a chain of fingerprints, the middle one only in rows without an id."""
    import random

    rng, links = random.Random(11), None
    while links is None:
        words = [f"w{rng.randrange(400)}" for _ in range(60)]
        chain = [" ".join(words)]
        for k in (20, 40):
            words = list(words)
            words[k] = f"v{rng.randrange(400)}"
            chain.append(" ".join(words))
        a, b, c = (int.from_bytes(simhash.fingerprint(t.encode())) for t in chain)
        if (a ^ b).bit_count() <= 4 and (b ^ c).bit_count() <= 4 < (a ^ c).bit_count():
            links = chain
    rows = [(1, links[0]), (None, links[1]), (2, links[2])]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.component_id for r in got] == [1, 1, 1]


def test_wide_bands_lose_no_pair(spark):
    for rows in (10, 10**8, 10**11):
        bands = simhash.lossless_bands(1, 4, rows, 100_000)
        assert len(bands) == {10: 5, 10**8: 15, 10**11: 35}[rows]
    import random

    rng = random.Random(12)
    for _ in range(300):
        off = set(rng.sample(range(64), 4))
        assert any(off.isdisjoint(b) for b in bands) and any(off.isdisjoint(b) for b in simhash.lossless_bands(1, 4, 10**8, 100_000))


def test_late_stages(spark, docs):
    from pyspark.sql import functions as F

    rows = docs.withColumns({"n_chars": F.length("text").cast("long"), "lang": F.lit(None).cast("string")})
    out = stage("PII")(spark, rows, "")
    assert out.columns == rows.columns and out.count() == len(ROWS) and out.where("text is null").count() == 1
    assert stage("PII")(spark, rows.where("false"), "").collect() == []
    pieces = stage("packing")(spark, rows, "").collect()
    assert {r.doc_id for r in pieces} == {r[0] for r in ROWS} and stage("packing")(spark, rows.where("false"), "").collect() == []
    again = stage("packing")(spark, rows.repartition(5), "").collect()
    assert sorted(map(str, pieces)) == sorted(map(str, again))  # whatever files the rows come from


def test_exact_copies_leave_one(docs, labels):
    kept = exact_dedup.drop_exact_copies(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["1", "3", "None", "5", "7", "8"])  # null and empty are equal


def test_pii_keeps_other_columns(docs):
    out = pii.pseudonyms(docs)
    assert out.columns == [*docs.columns, "pii_kinds"]
    assert all(r["_t"] == "clash _t" and r["_m"] == "clash _m" for r in out.collect())
