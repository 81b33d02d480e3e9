"""Shuffled shards by a two-pass external shuffle, with DataFrame functions only.

The first pass marks every row with a seeded hash and writes it; the leading part of the hash is its
bucket, of which there are as many as keep one within a task's memory, and at least one per shard. The second pass deals the rows
to their buckets and gives each the place that a Fisher-Yates shuffle of its bucket says. Buckets
laid end to end are one random order of all rows, cut into shards whose row counts differ by at
most one.

The shuffles (arrays of places, one per bucket) are staged before use, so whatever is computed again
finds the same order. The rows themselves are only ever sorted, never gathered: a bucket may spill.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factorspark.sources.staging import stage, stage_observed

BUCKET_BYTES = 32 << 20
GROUP = 1024  # buckets whose sizes are added up by one task
ROW_BYTES = 16  # of a row besides its text
_HASH_BITS = 53


def text_bytes(text: str) -> F.Column:
    """Bytes of a text in UTF-8 and of the row around it; a null text has none."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + ROW_BYTES).cast("long")


def _orders(marked: DataFrame, seed: int) -> DataFrame:
    """``(bucket, start, places)``: rows of earlier buckets, and the shuffled places of its own."""
    sizes = marked.groupBy("bucket").agg(F.count("*").alias("n"))
    places = F.shuffle(F.sequence(F.lit(0), F.col("n").cast("int") - 1), F.lit(seed))
    orders = stage(sizes.select("bucket", "n", places.alias("places")), "bucket-orders")
    part = F.floor(F.col("bucket") / GROUP).cast("int")
    sized = orders.select("bucket", "n", part.alias("part"))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sized.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sized.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, "part")
    return orders.join(starts.select("bucket", (F.col("before") + F.col("inside")).alias("start")), "bucket").select(
        "bucket", "start", "places"
    )


def shuffled(docs: DataFrame, shards: int = 40, seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Every row of ``docs(text, ..)`` as struct ``row`` with its ``shard`` (0 to ``shards`` - 1) and
    ``slot``, its place in the shard from 0 without gaps.

    Shards differ by one row at most; with fewer rows than shards some are empty. Neither ids nor texts
    decide where a row goes, so nulls, copies and repeated rows are rows like others. The order follows
    from ``seed`` and the layout of the table. An empty table gives an empty result. A bucket has at
    least one row, so memory grows with the longest text.
    """
    if shards < 1 or bucket_bytes < 1:
        raise ValueError("shards and bucket_bytes have to be positive")
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    numbered = docs.select(row, text_bytes("text").alias("size")).withColumn("number", F.monotonically_increasing_id())
    written, seen = stage_observed(numbered, "numbered", rows=F.count("*"), size=F.coalesce(F.sum("size"), F.lit(0)))
    buckets = max(shards, -(-seen["size"] // bucket_bytes))
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("number")), 64 - _HASH_BITS)
    bucket = F.floor(drawn / F.lit(float(1 << _HASH_BITS)) * buckets).cast("int")
    marked = written.select("row", "number", bucket.alias("bucket"))

    by_hash = Window.partitionBy("bucket").orderBy("number")
    # as many partitions as buckets, on both sides of the join, so that their size does not grow with the table
    ranked = marked.repartition(buckets, "bucket").withColumn("nth", F.row_number().over(by_hash))
    orders = _orders(marked, seed).repartition(buckets, "bucket")
    at = F.col("start") + F.element_at("places", F.col("nth"))
    placed = ranked.join(orders, "bucket").select("row", at.alias("at"))
    rows = F.lit(max(1, seen["rows"])).cast("long")
    shard = F.call_function("div", F.col("at") * shards, rows)
    first = F.call_function("div", F.col("shard") * rows + (shards - 1), F.lit(shards).cast("long"))
    return placed.withColumn("shard", shard.cast("int")).select("row", "shard", (F.col("at") - first).cast("long").alias("slot"))


def write_shards(found: DataFrame, folder: str) -> None:
    """The shuffled rows as Parquet, one folder per shard, each file in the order of its slots."""
    rows = found.select("row.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    ordered = rows.repartition("_shard", F.floor(F.col("_slot") / 1_000_000)).sortWithinPartitions("_shard", "_slot")
    ordered.write.partitionBy("_shard").parquet(folder)
