"""Connected components by contraction and pointer jumping; all state stays in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recipeframe.runtime import join_hot, materialize, scratch


def rooted(rows: DataFrame, col: str, roots: DataFrame, out: str) -> DataFrame:
    """``rows`` with ``out``, the root of ``col`` in roots (node, root), itself where it has none; ``col`` may be skewed."""
    n = rows.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    known = n.join(roots.select(F.col("node").alias(col), F.col("root").alias("_root")), col, "left").select(col, "_n", F.coalesce("_root", col).alias(out))
    return join_hot(rows, materialize(known, "rooted"), col, "_n").drop("_n")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node of its component.

    A round hooks each node to its smallest neighbour, jumps pointers until each points at a root, and replaces the
    edges by edges between roots. Each node with an edge merges, so edges vanish after a few rounds whatever the
    diameter. A node may have a large part of all edges: joins on nodes treat such hubs apart. Self loops, repeated edges
    and nulls are ignored. Empty edges give an empty table."""
    with scratch() as keep:
        both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
        live = materialize(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        result: DataFrame | None = None
        while not live.isEmpty():
            ends = live.select("u", "v").unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
            up = materialize(ends.groupBy(F.col("u").alias("node")).agg(F.least("node", F.min("v")).alias("root"), F.count(F.lit(1)).alias("degree")), "up")
            while True:
                pointed = up.groupBy("root").agg(F.count(F.lit(1)).alias("_n"))
                there = materialize(pointed.join(up.select(F.col("node").alias("root"), F.col("root").alias("_next")), "root"), "there")
                if there.where("_next <> root").isEmpty():
                    break
                up = materialize(join_hot(up, there, "root", "_n").select("node", F.col("_next").alias("root"), "degree"), "jump")
            at_u = join_hot(live, up.select(F.col("node").alias("u"), F.col("root").alias("ru"), "degree"), "u", "degree").drop("degree")
            at_v = join_hot(at_u, up.select(F.col("node").alias("v"), F.col("root").alias("rv"), "degree"), "v", "degree")
            live = materialize(at_v.where("ru <> rv").select(F.greatest("ru", "rv").alias("u"), F.least("ru", "rv").alias("v")).distinct(), "edges")
            up = up.select("node", "root")
            result = up if result is None else rooted(result, "root", up, "_r").select("node", F.col("_r").alias("root"))
        if result is None:
            result = both.select(F.col("u").alias("node"), F.col("v").alias("root")).where("false")
        return keep(materialize(result, "components"))
