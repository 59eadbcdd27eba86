"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is joins and partial aggregations on distributed tables, so no adjacency list is
ever collected into one task; a hub with very many neighbours meets its minimum in a join whose large
side adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge.storage import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def component_roots(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(u, root) for every id that has a link; root is the smallest id reachable.

    ``links`` holds pairs of longs in columns ``a`` and ``b``. Pairs with a null or equal ids are no links.
    An empty table gives an empty result. Ids that are their own root and have no link do not appear.
    """
    pairs = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = materialize(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now["n"] == 0 or (now["n"], now["s"]) == before:
            return edges.select("u", F.col("v").alias("root"))
        before = (now["n"], now["s"])
        edges = materialize(_small_star(_large_star(edges)), "stars")
    raise RuntimeError("components did not settle")
