"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorspark.sources.staging import discard, stage_observed


def _star(pairs: DataFrame) -> DataFrame:
    """Hang every node of ``pairs`` (a > b) under the smallest of its neighbours in b.

    The minimum is combined before the shuffle, and adaptive execution can split the join, so a
    node with very many links does not meet in one task.
    """
    low = pairs.groupBy("a").agg(F.min("b").alias("m"))
    joined = pairs.join(low, "a")
    links = F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return joined.select(F.explode(links).alias("l")).select("l.a", "l.b").filter("a != b").distinct()


def _large_star(pairs: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node under the smallest of its neighbours and itself."""
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)``, both long, to ``(node, root)``: the smallest node of each component.

    Only nodes that have a link to another one are listed. Every step is staged, and the loop ends
    when the table of links stops changing; the driver sees a count and a checksum. A round is removed
    when the next one is written.
    """
    figures = {"n": F.count("*"), "sum": F.bit_xor(F.xxhash64("a", "b"))}
    pairs = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs, seen = stage_observed(pairs, "links", **figures)
    while seen["n"]:
        before, earlier = seen, pairs
        pairs, seen = stage_observed(_star(_large_star(earlier)), "links", **figures)
        discard(earlier)
        if seen == before:
            break
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
