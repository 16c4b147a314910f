"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.session import discard, written


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node of ``edges``; the component is its smallest node.

    Alternates the large-star and small-star steps: each node hands its larger neighbours, then
    its smaller ones, to the smallest node it knows.  A step is one grouping and one join on the
    node, edges never multiply, and the number of rounds is logarithmic in the longest path.
    Loops and repeated edges are harmless; an empty table gives no rows.
    """
    a, b = F.col("a"), F.col("b")
    now = written(
        edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).where(a != b).distinct()
    )
    before = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if state[0] == 0 or state == before:
            break
        before, last = state, now
        both = now.union(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where(b > a).join(least, "a").select(b.alias("a"), F.col("m").alias("b")).where(a != b).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(b.alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        now = written(small.where(a != b).distinct())
        discard(last)
    return (
        now.select(a.alias("node"), b.alias("component"))
        .union(now.select(b.alias("node"), b.alias("component")))
        .groupBy("node")
        .agg(F.min("component").alias("component"))
    )
