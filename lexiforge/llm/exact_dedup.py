"""Exact dedup by a tree merge of sorted digest runs, in DataFrame operations only.

Every scan partition makes a sorted run: its digests with, for each, the size of the group so far and the identifier that
stays. Runs then meet in binomial rounds: ``fan_in`` neighbouring runs merge into one of the next level, which is dealt
over all tasks by digest, until one run for each digest range is left. Copies collapse inside every run before anything is
shuffled, so a hot group costs a row for each run and not for each copy.

A digest is verified by the text's length and a second, independent hash that travel with it: texts are equal only if
all three agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiforge.storage import materialize

DIGEST = ["sha", "size", "check"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """Null as empty; A-Z and no other letter lower-cased."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row_no, run, sha, size, check) of every row, written once so that row numbers hold."""
    text = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t"))
    return materialize(
        text.select("id", F.monotonically_increasing_id().alias("row_no"), F.spark_partition_id().alias("run"), F.unhex(F.sha2("t", 256)).alias("sha"), F.octet_length("t").alias("size"), F.xxhash64("t").alias("check")),
        "digests",
    )


def merged_runs(runs: DataFrame, keep: str = "largest", fan_in: int = 16) -> DataFrame:
    """One row for each verified digest: (sha, size, check, best struct(id, row_no), n long)."""
    best = F.max if keep == "largest" else F.min
    count = runs.agg(F.max("run")).first()[0]
    # Ordered by id, nulls last in either direction, then by the first row.
    order = F.struct(F.col("id").isNotNull().alias("known") if keep == "largest" else F.col("id").isNull().alias("known"), F.col("id").alias("id"), (-F.col("row_no") if keep == "largest" else F.col("row_no")).alias("at"))
    level = runs.select(*DIGEST, "run", order.alias("best"), F.lit(1).cast("long").alias("n"))
    left = (count or 0) + 1
    while True:
        left = -(-left // fan_in)
        level = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")) if left > 1 else level.withColumn("run", F.lit(0))
        level = level.groupBy(*DIGEST, "run").agg(best("best").alias("best"), F.sum("n").alias("n"))
        if left <= 1:
            return level.drop("run")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", fan_in: int = 16) -> DataFrame:
    """A row for each row of ``docs``: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical after lower-casing A-Z; null counts as empty. keep_id is the smallest (or ``keep`` =
    "largest") id of the group; null ids are kept only where the group has no other. Exactly one row of each group has kept
    = true: of rows that repeat the id that stays, the first in scan order. An empty table gives an empty result.
    """
    runs = digests(docs, id_col, text_col)
    best = merged_runs(runs, keep, fan_in)
    joined = runs.join(best, DIGEST)
    return joined.select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row_no") == F.abs("best.at")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", fan_in: int = 16) -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns as before.

    Rows that repeat both id and text collapse to one of them.
    """
    runs = digests(docs, id_col, text_col)
    # Ids of a group are few against its text: one row for each (digest, id) decides, and only repeated rows are regrouped.
    stays = materialize(merged_runs(runs, keep, fan_in).select(*DIGEST, F.col("best.id").alias("id")), "stays")
    twice = runs.groupBy(*DIGEST, "id").count().where("count > 1").join(stays, [*DIGEST], "left_semi").select(*DIGEST, "id")
    t = normalised(F.col(text_col))
    names = [f"c{i}" for i in range(len(docs.columns))]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)]).alias("row"), F.col(id_col).alias("id"), F.unhex(F.sha2(t, 256)).alias("sha"), F.octet_length(t).alias("size"), F.xxhash64(t).alias("check"))
    same = lambda a, b: [a[c] == b[c] for c in DIGEST] + [a["id"].eqNullSafe(b["id"])]
    held = keyed.join(stays, same(keyed, stays), "left_semi")
    twice = materialize(twice, "twice")
    if not twice.isEmpty():
        again = held.join(twice, same(held, twice), "left_semi").groupBy(*DIGEST, "id").agg(F.first("row").alias("row")).select("row")
        held = held.join(twice, same(held, twice), "left_anti").select("row").union(again)
    return held.select(*[F.col(f"row.{n}").alias(c) for c, n in zip(docs.columns, names)])
