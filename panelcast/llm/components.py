"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Work


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each vertex's larger (or smaller) neighbours to the smallest one around it.
    Minima are combined map-side; a hub's rows stay single rows."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    near = low.select(F.col("u"), F.least("u", "m").alias("m"))
    moved = both.join(near, "u").where(F.col("v") > F.col("u") if large else F.lit(True))
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(near.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, work: Work, name: str = "cc", most_rounds: int = 100) -> DataFrame:
    """(id, component): the smallest reachable id of every vertex that has an edge;
    ``edges`` has integer columns u, v (any direction, repeats allowed)."""
    state, edges = None, work.table(edges.where("u <> v").distinct(), f"{name}-0")
    for i in range(1, most_rounds + 1):
        edges = work.table(_star(_star(edges, True), False), f"{name}-{i}")
        new = _state(edges)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
