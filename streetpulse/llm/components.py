"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from streetpulse.llm.tables import stored


def _neighbours_and_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _stored_with_sum(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written, with their number and a sum of hashes, in one job."""
    seen = Observation()
    edges = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")),
                   "components")
    return edges, (seen.get["n"], seen.get["s"])


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): label is the smallest
    node it reaches. Each step is written to the shared folder; the number of
    steps is logarithmic in practice. Least values are partial aggregates and
    hubs meet in an ordinary join, so one node's links never meet in one task
    unsplit."""
    edges, before = _stored_with_sum(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                                     .where("u <> v").distinct())
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _neighbours_and_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _neighbours_and_least(large)
        edges, now = _stored_with_sum(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        if now == before:
            break
        before = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("label"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def merged_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after further ``links`` (a, b): only the graph of
    the labels that the links tie together is solved, and composed with the
    labels so far. A node without a label is its own."""
    own = {k: labels.select(F.col("node").alias(k), F.col("label").alias(f"label_{k}")) for k in "ab"}
    tied = links.join(own["a"], "a", "left").join(own["b"], "b", "left").select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")).where("a <> b")
    moved = components(tied)
    to = moved.select(F.col("node").alias("label"), F.col("label").alias("to"))
    kept = labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return stored(kept.unionByName(moved.join(labels.select("node"), "node", "left_anti")), "component-labels")
