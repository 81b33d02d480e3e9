"""Month-grain marts. ``rebalance_date`` is the formation date; returns are earned afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorspark.functions import ratio
from factorspark.operators.ranking import min_ranks, ranked
from factorspark.params import MONTHS_PER_YEAR, QUINTILES
from factorspark.plans.scores import CROSS_SECTION, FORWARD


RANK = "rk_score"


def ranked_scores(scored: DataFrame) -> DataFrame:
    """(ticker, rebalance_date, factor, raw_value, score, quintile, fwd_ret_1m, rk_score) from scores that
    already carry their forward return.

    One sort by score gives both: the quintile, for which every scored name counts, and ``rk_score``, the
    rank among the names with a forward return, NULL for the others."""
    rows = scored.select("ticker", *CROSS_SECTION, "raw_value", "score", FORWARD)
    found = ranked(rows, CROSS_SECTION, "score", "ticker", {"quintile": QUINTILES}, {RANK: F.col(FORWARD).isNotNull()})
    return found.select("ticker", *CROSS_SECTION, "raw_value", "score", "quintile", FORWARD, RANK)


def scores_with_forward(scores: DataFrame, forward: DataFrame) -> DataFrame:
    """Every score with its forward return where there is one. Both tables are stored in the same buckets
    by (ticker, rebalance_date), so the merge join asked for reads them without a shuffle, at any size."""
    return scores.join(forward.hint("merge"), ["ticker", "rebalance_date"], "left")


def mart_scores_monthly(scores: DataFrame, forward: DataFrame) -> DataFrame:
    """Quintile of every scored name, with its forward return where there is one, from two tables.
    A run takes both from its month-end rows instead, without this join."""
    return ranked_scores(scores_with_forward(scores, forward)).drop(RANK)


def _earned(scores_monthly: DataFrame) -> DataFrame:
    return scores_monthly.filter(F.col(FORWARD).isNotNull())


def mart_factor_returns(scores_monthly: DataFrame) -> DataFrame:
    """(rebalance_date, factor, q1_ret..q5_ret, ls_ret, n_names)"""
    numbers = range(1, QUINTILES + 1)
    means = [F.avg(F.when(F.col("quintile") == q, F.col("fwd_ret_1m"))).alias(f"q{q}_ret") for q in numbers]
    return (
        _earned(scores_monthly)
        .groupBy(*CROSS_SECTION)
        .agg(*means, F.count("fwd_ret_1m").alias("n_names"))
        .select(
            *CROSS_SECTION,
            *[f"q{q}_ret" for q in numbers],
            (F.col(f"q{QUINTILES}_ret") - F.col("q1_ret")).alias("ls_ret"),
            "n_names",
        )
    )


def correlation(x: str, y: str) -> Column:
    """Pearson correlation, NULL when a side is constant (the built-in raises there in ANSI mode)."""
    return ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def mart_ic(scores_monthly: DataFrame) -> DataFrame:
    """(rebalance_date, factor, ic, n_names): correlation of score rank and forward-return rank. Where
    the table has the score ranks already, one sort is left, by forward return."""
    known = RANK in scores_monthly.columns
    earned = _earned(scores_monthly).select("ticker", *CROSS_SECTION, FORWARD, RANK if known else "score")
    missing = {"rk_fwd": FORWARD} if known else {RANK: "score", "rk_fwd": FORWARD}
    return (
        min_ranks(earned, CROSS_SECTION, missing, "ticker")
        .groupBy(*CROSS_SECTION)
        .agg(correlation(RANK, "rk_fwd").alias("ic"), F.count("*").alias("n_names"))
    )


def share_positive(col: str) -> Column:
    """Share of all rows with a positive value; NULL counts as not positive."""
    return F.avg(F.when(F.col(col) > 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def spread_statistics() -> dict[str, Column]:
    """Annualised statistics of monthly ``ls_ret``: arithmetic mean x 12, deviation x sqrt(12)."""
    yearly = F.avg("ls_ret") * MONTHS_PER_YEAR
    risk = F.stddev_samp("ls_ret") * F.sqrt(F.lit(float(MONTHS_PER_YEAR)))
    return {"ann_ls_return": yearly, "ann_ls_vol": risk, "ls_sharpe": ratio(yearly, risk)}


def ic_statistics() -> dict[str, Column]:
    return {"mean_ic": F.avg("ic"), "icir": ratio(F.avg("ic"), F.stddev_samp("ic"))}


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def mart_factor_summary(factor_returns: DataFrame, ic: DataFrame) -> DataFrame:
    """One row per factor: months, annualised spread statistics, hit rate, mean IC and ICIR."""
    spread = factor_returns.groupBy("factor").agg(
        F.count("*").alias("n_months"), *_named(spread_statistics()), share_positive("ls_ret").alias("hit_rate")
    )
    return spread.join(ic.groupBy("factor").agg(*_named(ic_statistics())), "factor")
