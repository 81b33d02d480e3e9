"""Comparison of two runs: the same prices must give the same marts.

Both sides are stacked and grouped by key instead of joined. Each key arrives pre-aggregated, so
even a key repeated on both sides costs one row per task and not the product of its copies; the
aggregates still give exactly what all pairs of its rows would.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorspark.params import QUINTILES

TABLES = (
    "raw_prices",
    "dim_factor",
    "returns",
    "market",
    "rebalance_dates",
    "signals",
    "scores",
    "fwd_returns",
    "mart_scores_monthly",
    "mart_factor_returns",
    "mart_ic",
    "mart_factor_summary",
    "dim_month",
)
ROW_KEYS = ["ticker", "rebalance_date", "factor"]
TOLERANCE = 1e-9


def _stack(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.withColumn("side", F.lit("a")).unionByName(b.withColumn("side", F.lit("b")))


def _on(side: str, value: Column) -> Column:
    return F.when(F.col("side") == side, value)


def _passes(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def count_rows(tables, names=TABLES) -> DataFrame:
    """(table_name, n_rows)"""
    counts = [getattr(tables, t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n_rows")) for t in names]
    return reduce(DataFrame.unionByName, counts)


def parity_counts(a, b, names=TABLES) -> DataFrame:
    """(table_name, n_a, n_b, same)"""
    sides = _stack(count_rows(a, names), count_rows(b, names)).groupBy("table_name")
    return sides.agg(
        F.sum(_on("a", F.col("n_rows"))).alias("n_a"), F.sum(_on("b", F.col("n_rows"))).alias("n_b")
    ).withColumn("same", F.col("n_a") == F.col("n_b"))


def parity_summary(a: DataFrame, b: DataFrame, tol: float = TOLERANCE) -> DataFrame:
    """(metric, max_diff, n_one_sided, same) per column of mart_factor_summary: largest absolute
    difference over the factors, and factors that only one side has."""
    metrics = [c for c in a.columns if c != "factor"]

    def by_metric(summary: DataFrame) -> DataFrame:
        doubles = [F.col(c).cast("double") for c in metrics]
        return summary.select("factor", *doubles).unpivot("factor", metrics, "metric", "value")

    long = _stack(by_metric(a), by_metric(b))
    pairs = long.groupBy("factor", "metric").agg(
        F.max(_on("a", F.col("value"))).alias("a"),
        F.max(_on("b", F.col("value"))).alias("b"),
        F.count_distinct("side").alias("sides"),
    )
    compared = pairs.groupBy("metric").agg(
        F.max(F.abs(F.col("a") - F.col("b"))).alias("max_diff"),
        F.max(F.abs("a")).alias("max_a"),
        F.count_if(F.col("sides") == 1).alias("n_one_sided"),
    )
    within = F.col("max_diff") <= F.greatest(F.lit(tol), tol * F.col("max_a"))
    return compared.select(
        "metric", "max_diff", "n_one_sided", _passes(within & (F.col("n_one_sided") == 0)).alias("same")
    )


def key_sides(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, n_keys): row pairs found on both sides, and rows whose key only one side has."""
    counts = (
        _stack(a.select(*ROW_KEYS), b.select(*ROW_KEYS))
        .groupBy(*ROW_KEYS)
        .agg(F.count_if(F.col("side") == "a").alias("n_a"), F.count_if(F.col("side") == "b").alias("n_b"))
    )
    side = F.when(F.col("n_b") == 0, "only_a").when(F.col("n_a") == 0, "only_b").otherwise("both")
    rows = F.greatest(F.col("n_a"), F.lit(1)) * F.greatest(F.col("n_b"), F.lit(1))
    return counts.groupBy(side.alias("side")).agg(F.sum(rows).alias("n_keys"))


def _key_profile(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per key and side: row count, rows per quintile, range and valid count of both measures."""
    measures = ("score", "fwd_ret_1m")
    aggregates = []
    for s in ("a", "b"):
        here = F.col("side") == s
        aggregates.append(F.count_if(here).alias(f"n_{s}"))
        aggregates += [
            F.count_if(here & (F.col("quintile") == q)).alias(f"q{q}_{s}") for q in range(1, QUINTILES + 1)
        ]
        for m in measures:
            value = _on(s, F.col(m).cast("double"))
            aggregates += [
                F.count(value).alias(f"{m}_n_{s}"),
                F.min(value).alias(f"{m}_min_{s}"),
                F.max(value).alias(f"{m}_max_{s}"),
            ]
    columns = [*ROW_KEYS, "quintile", *measures]
    return _stack(a.select(*columns), b.select(*columns)).groupBy(*ROW_KEYS).agg(*aggregates)


def parity_rows(a: DataFrame, b: DataFrame, tol: float = TOLERANCE) -> DataFrame:
    """One row over mart_scores_monthly: rows with a one-sided key, compared pairs, quintile
    disagreements (a missing quintile never agrees), largest score and forward-return difference,
    and pairs where just one side has the value (reported, not part of ``same``)."""
    pairs = F.col("n_a") * F.col("n_b")
    agreeing = sum((F.col(f"q{q}_a") * F.col(f"q{q}_b") for q in range(1, QUINTILES + 1)), start=F.lit(0))

    def widest(m: str) -> Column:
        reach = F.greatest(
            F.col(f"{m}_max_a") - F.col(f"{m}_min_b"), F.col(f"{m}_max_b") - F.col(f"{m}_min_a")
        )
        return F.max(F.when((F.col(f"{m}_n_a") > 0) & (F.col(f"{m}_n_b") > 0), reach))

    def half_null(m: str) -> Column:
        valid_a, valid_b = F.col(f"{m}_n_a"), F.col(f"{m}_n_b")
        return valid_a * (F.col("n_b") - valid_b) + valid_b * (F.col("n_a") - valid_a)

    def total(x: Column) -> Column:
        return F.coalesce(F.sum(x), F.lit(0))

    result = _key_profile(a, b).agg(
        total(F.when(pairs == 0, F.col("n_a") + F.col("n_b"))).alias("n_one_sided"),
        total(pairs).alias("n_pairs"),
        total(pairs - agreeing).alias("n_quintile_diff"),
        widest("score").alias("max_score_diff"),
        widest("fwd_ret_1m").alias("max_fwd_diff"),
        total(half_null("score") + half_null("fwd_ret_1m")).alias("n_null_mismatch"),
    )
    same = (
        (F.col("n_one_sided") == 0)
        & (F.col("n_quintile_diff") == 0)
        & (F.col("max_score_diff") <= tol)
        & (F.col("max_fwd_diff") <= tol)
    )
    return result.withColumn("same", _passes(same))


def parity(a, b, tol: float = TOLERANCE) -> DataFrame:
    """(section, item, difference, same): the whole comparison of two runs, whose tables are the
    attributes of ``a`` and ``b``."""
    counts = parity_counts(a, b).select(
        F.lit("row counts").alias("section"),
        F.col("table_name").alias("item"),
        F.abs(F.col("n_a") - F.col("n_b")).cast("double").alias("difference"),
        "same",
    )
    summary = parity_summary(a.mart_factor_summary, b.mart_factor_summary, tol).select(
        F.lit("factor summary").alias("section"),
        F.col("metric").alias("item"),
        F.col("max_diff").alias("difference"),
        "same",
    )
    measured = ["n_one_sided", "n_quintile_diff", "max_score_diff", "max_fwd_diff"]
    rows = (
        parity_rows(a.mart_scores_monthly, b.mart_scores_monthly, tol)
        .select(*[F.col(c).cast("double") for c in measured])
        .unpivot([], measured, "item", "difference")
        .select(
            F.lit("score rows").alias("section"),
            "item",
            "difference",
            _passes(F.col("difference") <= F.when(F.col("item").startswith("n_"), 0.0).otherwise(tol)).alias("same"),
        )
    )
    return counts.unionByName(summary).unionByName(rows)


def has_parity(comparison: DataFrame) -> bool:
    return comparison.filter(~F.col("same")).isEmpty()
