"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours of a node are tied to the smallest of them.

    Large: the larger neighbours; small: the smaller ones and the node itself. Nodes have few
    neighbours after the first steps except the smallest of a component, whose edges are all kept as
    they are; minima are taken map-side, so no neighbourhood is collected.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    tied = both.join(least, "u")
    if large:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """node and component (its smallest node) of every node of the edge table (u, v).

    With the `labels` of earlier edges, `edges` need only hold the new ones: they are drawn between
    the components found before. Each round is written to the shared folder, so a lost executor costs
    one round; the number of rounds grows with the logarithm of the largest component.
    """
    if labels is not None:
        return _joined(edges, labels)
    current = materialize(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        state = current.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if state == before or state["n"] == 0:
            break
        before = state
        current = materialize(_star(_star(current, large=True), large=False), "stars")
    found = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def _joined(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """`labels` with the components that the edges tie together made one."""
    drawn = edges.select("u", "v")
    for end in ("u", "v"):
        of = labels.select(F.col("node").alias(end), F.col("component").alias("_of"))
        drawn = drawn.join(of, end, "left").withColumn(end, F.coalesce("_of", end)).drop("_of")
    tied = components(drawn).select(F.col("node").alias("component"), F.col("component").alias("_to"))
    old = labels.join(tied, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    fresh = tied.select(F.col("component").alias("node"), F.col("_to").alias("component")).join(
        labels, "node", "left_anti"
    )
    return materialize(old.unionByName(fresh), "labels")
