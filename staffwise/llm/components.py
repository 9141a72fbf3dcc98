"""Connected components of an edge table by alternating large and small stars.

Every round is one aggregation and one join per star; its edges are written to
the shared folder, so no lineage grows and no edge reaches the driver. The
rounds end when the edges no longer change: then every node hangs on the
smallest node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffwise.llm.shared import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
    return row[0], row[1] or 0


def _hang(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """Edges (v, smallest of u's neighbourhood) for each pair (u, v)."""
    least = of.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns u, v): label is the smallest node reachable."""
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(edges)
    while True:
        # large star: neighbours above a node move to the smallest of its neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hang(both.where("v > u"), both).where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()
        # small star: neighbours below a node, and the node itself, move to the smallest of them
        small = _hang(large, large).unionByName(large.groupBy("u").agg(F.min("v").alias("b")).select(F.col("u").alias("a"), "b"))
        edges = stored(small.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "edges")
        last, state = state, _state(edges)
        if state == last:
            break
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return pairs.unionByName(pairs.select(F.col("label").alias("node"), "label").distinct())
