"""Connected components of a distributed edge list.

Alternating star contraction: in the large step every neighbour greater than
a node is linked to the smallest node around it, in the small step the other
way; the edge list shrinks to one star per component in a logarithmic number
of rounds. Every round is a shuffle of the edge list, written to the shared
folder; only its row count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that is not the smallest of its component.

    ``edges`` has two columns of one orderable type; null ends and self links
    are ignored, repeated links count once. A node absent from the result is
    its own root (or has no link). No links: an empty result.
    """
    a, b = edges.columns[:2]
    e = (edges.where(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = written(e, "edges")
    seen = _fingerprint(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = written(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = written(small, "small-star")
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
