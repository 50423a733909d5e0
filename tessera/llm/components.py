"""Connected components of an edge table by alternating stars.

Large-star links every node's larger neighbours to its smallest neighbour,
small-star does the same for the smaller ones; repeated, every component ends
as one star around its smallest node, in a number of rounds logarithmic in the
number of edges. Each round works on at most as many edges as there were, and
is cut off by a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.util import ensure_checkpoint_dir


def _star(near: DataFrame, keep: str) -> DataFrame:
    """Edges (v, smallest neighbour of u) for the neighbours v of u that ``keep`` selects."""
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    far = near.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return far.where("u <> v")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its smallest node."""
    ensure_checkpoint_dir(edges.sparkSession)
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = now.distinct().checkpoint()
    sign, before = F.struct(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))), None
    while (mark := now.agg(sign.alias("s")).first()["s"]) != before:
        before = mark
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, "v > u").distinct()
        # large-star leaves u > v on every edge
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = small.union(least.select("u", F.col("m").alias("v"))).distinct().checkpoint()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct()
    )
