"""Mixing sources to target weights by capped water-filling.

Each source gets a share of the total size by its weight, but at most ``max_epochs`` times its own
size. What a clamped source cannot take is dealt to the others by weight, until none is above its
cap. A target of 2.4 times a source means two whole repetitions of each of its documents and a
seeded sample of 0.4 of its words: the documents in the order of a seeded hash, until the words are
reached; the last one in part. So every source takes its target, rounded to whole words.

The table of sources has one row per source and is never collected: each round of the filling is an
aggregate of two numbers. Documents of a source are dealt into slots of that hash order, as many as
the table needs; a running total over the sizes of the slots gives each slot its start, so a source
with most of the rows is spread over many tasks. Ids that very many rows share are dealt by the staged
place of each row instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorspark.sources.staging import stage, stage_counted, stage_observed

# ASCII white space.
SPACE = r"[\x20\x09-\x0D]"
SLOT_ROWS = 20_000
BROADCAST_IDS = 1_000_000  # repeated ids, 8 bytes each, that are still broadcast
HASH_BITS = 56


def word_count(text: str) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(f"[^{SPACE[1:-1]}]+")), F.lit(0)).cast("long")


def seeded_order(key: str, seed: int) -> Column:
    """A number below 2^HASH_BITS from the MD5 of seed and key; SQL engines agree on it."""
    digits = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return F.conv(F.substring(digits, 1, HASH_BITS // 4), 16, 10).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``rank`` from 0: by code point, null last.

    Sorted runs are counted per partition, so no task sees all sources; the counts of the runs are
    one row per partition.
    """
    order = [F.col("source").asc_nulls_last()]
    runs = stage(
        sources.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("seq")),
        "sources",
    )
    sizes = runs.groupBy("run").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    starts = sizes.select("run", shift.alias("shift"))
    return runs.join(starts, "run").select("origin", "source_size", (F.col("seq") + F.col("shift")).alias("rank"))


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """``sources(.., source_size, weight)`` with ``target``: the weighted shares of ``total``, clamped.

    A round clamps every source whose share is above its cap and deals the rest out again; it ends
    when none is above. Sources without size get 0.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    rate, open_weight = 0.0, None
    while True:
        # the rate grows from round to round, so what was clamped stays clamped
        clamped = F.col("weight") * F.lit(rate) > cap
        row = sources.agg(
            F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if row["open"] in (open_weight, 0.0):
            return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(rate)))
        open_weight = row["open"]
        rate = (float(total) - row["taken"]) / open_weight


def _in_slots(sized: DataFrame, slots: int, seed: int) -> DataFrame:
    """Add ``slot`` by ``at``.

    Only an id that many rows share can fill a slot far above ``SLOT_ROWS``. Where one does, the rows of
    such ids get an ``at`` of their own from their staged place, so they go into all slots.
    """
    number = F.floor(F.col("at") / F.lit(float(1 << HASH_BITS)) * slots).cast("int")
    slot = F.least(number, F.lit(slots - 1))
    slotted = sized.withColumn("slot", slot)
    crowded = slotted.groupBy("origin", "slot").agg(F.count("*").alias("n")).filter(F.col("n") > 2 * SLOT_ROWS)
    crowded, n = stage_counted(crowded.select("origin", "slot"), "crowded")
    if not n:
        return slotted
    within = slotted.join(crowded, ["origin", "slot"], "left_semi").groupBy("at").agg(F.count("*").alias("n"))
    shared, n = stage_counted(within.filter(F.col("n") > max(1, SLOT_ROWS // 20)).select("at"), "shared-ids")
    shared = shared.withColumn("shared", F.lit(True))
    marked = sized.join(F.broadcast(shared) if n <= BROADCAST_IDS else shared, "at", "left")
    at = F.when(F.col("shared"), seeded_order("row", seed)).otherwise(F.col("at"))
    return marked.withColumn("at", at).drop("shared").withColumn("slot", slot)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    max_epochs: float = 3.0,
    seed: int = 42,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """How often every row of ``docs(doc_id, text, source)`` goes into the mix.

    Returns the columns of ``keep`` with ``size`` (words), ``source_size``, ``target`` (of the
    source), ``whole`` (whole repetitions), ``part`` (words of one more, cut short or complete) and
    ``taken`` = ``whole * size + part``. Sources in code point order, null last, weigh ``weights`` in
    turn and share the words of all documents.

    A null text has size 0 and is taken 0 times; a null source is a source like others; repeated rows
    are rows of their own (equal doc_ids are ordered by their staged place, or by a hash of it if very many share an id); sources without words
    have target 0; an empty table gives an empty result; other columns are ignored.
    """
    if min(weights) <= 0:
        raise ValueError("weights have to be positive")
    kept = list(dict.fromkeys(keep))
    # a key without null, so that windows and joins share one exchange
    origin = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("origin")
    sized = docs.select(
        *[F.col(f"`{name}`").alias(f"keep_{name}") for name in kept],
        origin,
        F.col("source").alias("source"),
        word_count("text").alias("size"),
        seeded_order("doc_id", seed).alias("at"),
        F.col("doc_id").alias("id"),
    ).withColumn("row", F.monotonically_increasing_id())
    sized, seen = stage_observed(sized, "sizes", rows=F.count("*"), words=F.coalesce(F.sum("size"), F.lit(0)))

    sources = _ranked(sized.groupBy("origin", "source").agg(F.sum("size").alias("source_size")))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighted = stage(sources.select("origin", "source_size", turn.alias("weight")), "weights")
    filled = stage(water_fill(weighted, seen["words"], max_epochs), "targets")

    # whole repetitions, and the words left for a sample of documents; 10^-9 absorbs rounding
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate + 1e-9).cast("long")
    rest = F.greatest(F.lit(0), F.round(F.col("target")).cast("long") - whole * F.col("source_size"))
    plan = filled.select("origin", "source_size", "target", whole.alias("whole"), rest.alias("rest"))

    slots = max(1, -(-seen["rows"] // SLOT_ROWS))
    slotted = _in_slots(sized, slots, seed)
    earlier = Window.partitionBy("origin").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        slotted.groupBy("origin", "slot")
        .agg(F.sum("size").alias("words"))
        .select("origin", "slot", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
        .join(plan, "origin")
    )
    in_slot = Window.partitionBy("origin", "slot").orderBy("at", "id", "row")
    running = F.sum("size").over(in_slot.rowsBetween(Window.unboundedPreceding, 0))
    placed = slotted.withColumn("before", running - F.col("size")).join(starts, ["origin", "slot"])
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start") - F.col("before")))
    return (
        placed.withColumn("part", part)
        .withColumn("taken", F.col("whole") * F.col("size") + F.col("part"))
        .select(
            *[F.col(f"`keep_{name}`").alias(name) for name in kept],
            *["size", "source_size", "target", "whole", "part", "taken"],
        )
    )


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words of a text with the white space between them."""
    # zero-width cuts before each word keep the white space with the word before it
    words = F.split(F.regexp_replace(text, f"^{SPACE}+", ""), f"(?<={SPACE})(?=[^{SPACE[1:-1]}])")
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def mixed_documents(
    docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), max_epochs: float = 3.0, seed: int = 42
) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row per whole repetition, and one per partial
    repetition with the first ``part`` words of its text."""
    row = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), "doc_id", "text", "source")
    mixed = mix(row, weights, max_epochs, seed, keep=["row"])
    copies = F.col("whole") + (F.col("part") > 0).cast("long")
    cut = (F.col("copy") > F.col("whole")) & (F.col("part") < F.col("size"))
    text = F.when(cut, first_words(F.col("row.text"), F.col("part"))).otherwise(F.col("row.text"))
    return (
        mixed.filter(copies > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
        .select(*[text.alias("text") if name == "text" else F.col(f"row.`{name}`") for name in docs.columns])
    )
