"""Connected components of a graph, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of `edges` (a, b): the least id it can reach.

    Large-star and small-star in turn: every node hands the least of its
    neighbours to the larger ones, then to the smaller ones, until nothing
    changes; that takes logarithmically many rounds whatever the shape. Each
    round is stored, so a hub's edges can be split among tasks, and the driver
    only learns a count and a checksum. Edges of a node to itself do nothing.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    state = _state(now)
    while state[0]:
        before = state
        now = _star(_star(now, large=True), large=False)
        state = _state(now)
        if state == before:
            break
    # Every node but the least of a component now points at that.
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """`edges` point from the larger id to the smaller."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")), "star-least")
    joined = both.join(least, "u")
    m = F.least("u", "m")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), m.alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), m.alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return stored(out.where("a <> b").distinct(), "star")
