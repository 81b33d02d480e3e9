"""Exact ranks inside groups of any size.

A ranking window would sort each group in one task. Here one range-partitioned sort over (group, value,
row) splits a group over as many tasks as it needs. Each sorted run is scanned once, in Arrow batches:
where the value differs from that of the row before, a tie begins. The runs are stored, and a table with
one row per group and run says where each run starts in its group and whether its first tie began
earlier.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from factorspark.sources.staging import stage_counted, stage_small as stage

BROADCAST_ROWS = 1_000_000  # rows of the table of runs that are still broadcast


def _scanned(rows: DataFrame, group: Sequence[str], value: str, marks: Sequence[str]) -> DataFrame:
    """Add to sorted rows their run, their place in the group's part of it, and per mark how many marked
    rows of that part come before the row's tie."""
    ties = [f"_tie{mark}" for mark in marks]
    schema = StructType(list(rows.schema.fields)).add("_run", IntegerType()).add("_place", LongType())
    for tie in ties:
        schema = schema.add(tie, LongType())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId()
        last: dict[str, pa.Array] = {}
        place = 0  # of the next row, if its group goes on
        marked = np.zeros(len(marks), np.int64)  # in the group so far
        before_tie = np.zeros(len(marks), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue

            def changed(names: Sequence[str]) -> np.ndarray:
                out = np.zeros(n, bool)
                for name in names:
                    column = batch.column(name)
                    before = pa.concat_arrays([last.get(name, column[:1]), column[: n - 1]])
                    differs = pc.fill_null(pc.not_equal(column, before), False)
                    one_null = pc.not_equal(column.is_null(), before.is_null())
                    out |= pc.or_(differs, one_null).to_numpy(zero_copy_only=False)
                return out

            at = np.arange(n)
            new_group = changed(group)
            new_tie = new_group | changed([value])
            if not last:
                new_group[0] = new_tie[0] = True
            # the row at which the group or the tie of each row began; -1: in an earlier batch
            group_at = np.maximum.accumulate(np.where(new_group, at, -1))
            tie_at = np.maximum.accumulate(np.where(new_tie, at, -1))
            places = np.where(group_at < 0, at + place, at - group_at)
            columns = [*batch.columns, pa.array(np.full(n, run, np.int32)), pa.array(places)]
            for k, mark in enumerate(marks):
                flags = batch.column(mark).to_numpy(zero_copy_only=False).astype(np.int64)
                seen = np.cumsum(flags) - flags + marked[k]
                ahead = np.where(group_at < 0, 0, seen[group_at])  # marked rows of earlier groups
                tie = np.where(tie_at < 0, before_tie[k], seen[tie_at] - ahead)
                columns.append(pa.array(tie))
                marked[k], before_tie[k] = seen[-1] + flags[-1] - ahead[-1], tie[-1]
            place = int(places[-1]) + 1
            last = {name: batch.column(name)[n - 1 :] for name in (*group, value)}
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(scan, schema)


def _run_table(runs: DataFrame, group: Sequence[str], value: str, marks: Sequence[str]) -> DataFrame:
    """One row per group and run, at most as many as there are groups plus range partitions: rows of the
    group in all and before the run, and per mark the marked rows before the run and the rank of its
    first value, whose tie may have begun in an earlier run."""
    per_mark = [F.count_if(F.col(mark)).alias(f"_n{mark}") for mark in marks]
    per_mark += [F.max_by(f"_tie{mark}", "_place").alias(f"_tail{mark}") for mark in marks]
    table = runs.groupBy(*group, "_run").agg(
        F.count("*").alias("_rows"),
        F.min_by(value, "_place").alias("_head"),
        F.max_by(value, "_place").alias("_tail"),
        *per_mark,
    )
    along = Window.partitionBy(*group).orderBy("_run")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    whole_group = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    shifts = {"_shift": total("_rows"), "_size": F.sum("_rows").over(whole_group)}
    shifts |= {f"_shift{mark}": total(f"_n{mark}") for mark in marks}
    goes_on = F.coalesce(F.lag("_tail").over(along) == F.col("_head"), F.lit(False))
    table = table.withColumns(shifts | {"_goes_on": goes_on})
    # where the last value of a run began: known in the run itself unless all of it goes on
    whole = F.col("_goes_on") & (F.col("_head") == F.col("_tail"))
    heads = {}
    for mark in marks:
        began = F.when(~whole, F.col(f"_tail{mark}") + F.col(f"_shift{mark}") + 1)
        before = F.last(began, ignorenulls=True).over(earlier)
        heads[f"_head{mark}"] = F.when(F.col("_goes_on"), before).otherwise(F.col(f"_shift{mark}") + 1)
    columns = ["_shift", "_size", "_head", *(f"_shift{mark}" for mark in marks), *heads]
    return table.withColumns(heads).select(*group, "_run", *columns)


def _bucket_of(position: Column, size: Column, buckets: int) -> Column:
    """NTILE arithmetic: the first ``size % buckets`` buckets hold one row more."""
    small = F.floor(size / buckets)
    extra = size % buckets
    in_large = extra * (small + 1)
    return F.when(position <= in_large, F.ceil(position / (small + 1))).otherwise(
        extra + F.ceil((position - in_large) / F.greatest(small, F.lit(1)))
    )


def ranked(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    row_key: str,
    ntiles: Mapping[str, int] | None = None,
    ranks: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add NTILE and RANK columns over one order, from a single sort by (group, value, row_key).

    ``ntiles`` maps a column to its number of buckets; rows that tie on the value go by ``row_key``, which
    identifies a row within its group. ``ranks`` maps a column, bigint, to a condition: RANK() among the
    rows of the group that fulfil it, NULL for the others; ties share the lowest rank. Values are not
    NULL. Rows that share a value never meet in one task.

    The sorted runs are staged before they are counted: a second evaluation could draw other range
    bounds. The table of runs is broadcast up to ``BROADCAST_ROWS`` rows, which are counted.
    """
    ntiles, ranks = ntiles or {}, ranks or {}
    marks = {f"_mark{k}": condition for k, condition in enumerate(ranks.values())}
    order = [*group, value, row_key]
    marked = df.withColumns({mark: F.coalesce(condition, F.lit(False)) for mark, condition in marks.items()})
    by_range = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = stage(_scanned(by_range, group, value, list(marks)), "sorted-runs")
    table, n = stage_counted(_run_table(runs, group, value, list(marks)), "runs")
    placed = runs.join(F.broadcast(table) if n <= BROADCAST_ROWS else table, [*group, "_run"])
    position = F.col("_place") + F.col("_shift") + 1
    found = {name: _bucket_of(position, F.col("_size"), buckets).cast("int") for name, buckets in ntiles.items()}
    for name, mark in zip(ranks, marks):
        here = F.col(f"_tie{mark}") + F.col(f"_shift{mark}") + 1
        rank = F.when(F.col(value) == F.col("_head"), F.col(f"_head{mark}")).otherwise(here)
        found[name] = F.when(F.col(mark), rank)
    return placed.select(*df.columns, *[column.alias(name) for name, column in found.items()])


def ntile(df: DataFrame, group: Sequence[str], value: str, row_key: str, buckets: int, column: str) -> DataFrame:
    """Add NTILE(``buckets``) per group by (value, row_key)."""
    return ranked(df, group, value, row_key, ntiles={column: buckets})


def min_ranks(df: DataFrame, group: Sequence[str], ranks: Mapping[str, str], row_key: str) -> DataFrame:
    """Add RANK() per group for every ``rank column: value column`` of ``ranks``, one sort each."""
    for name, value in ranks.items():
        df = ranked(df, group, value, row_key, ranks={name: F.lit(True)})
    return df
