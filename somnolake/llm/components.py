"""Connected components of a link table, by alternating star rounds over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somnolake.llm.columnar import written


def _state(edges: DataFrame) -> tuple[int, object]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(id, component_id): the smallest id reachable, for every id that has a link.

    `edges` hold a > b.  A large-star round hangs all larger neighbours of a node on the smallest
    node around it, a small-star round does so with the smaller neighbours; both keep the
    components, and the edges end as stars after about log rounds.  Minima are aggregated before
    the shuffle, and a round emits at most one row per edge, so a node with very many links costs
    no more than its links.  Nulls and self links are left out.
    """
    edges = (
        links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
        .where("a > b").distinct()
    )
    edges = written(edges, "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small_low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = moved.union(small_low.select("a", F.col("m").alias("b"))).where("a > b").distinct()
        edges = written(small, "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    members = edges.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    centres = edges.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
    return members.union(centres)
