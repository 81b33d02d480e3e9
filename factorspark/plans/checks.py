"""Invariants of a finished run. A failed ``fail`` check means the marts must not be used; a
``warn`` check is only reported."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorspark.functions import month_index
from factorspark.params import QUINTILES, WINSOR_LIMIT
from factorspark.plans.scores import CROSS_SECTION
from factorspark.sources.staging import stage

# Thresholds of the checks.
SCORE_TOLERANCE = 1e-6
EXTREME_RETURN = 0.8
HISTORY_SHARE = 0.75
MIN_MONTHS = 24


def _result(df: DataFrame, name: str, severity: str, n_bad: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("check"),
        F.lit(severity).alias("severity"),
        n_bad.cast("bigint").alias("n_bad"),
        detail.alias("detail"),
    )


def _counted(df: DataFrame, name: str, severity: str, text: str) -> DataFrame:
    """One row from the number of rows of ``df``."""
    n_bad = F.col("n_bad")
    detail = F.concat(n_bad.cast("string"), F.lit(f" {text}"))
    return _result(df.agg(F.count("*").alias("n_bad")), name, severity, n_bad, detail)


class Measures:
    """What the checks look at, in two passes over the scores mart: one by factor-month and quintile,
    one by ticker and month. ``stored`` keeps the results, for several checks."""

    def __init__(self, tables, stored: bool = False):
        self.tables = tables
        self._keep = stage if stored else lambda frame, name: frame

    @cached_property
    def quintiles(self) -> DataFrame:
        """(rebalance_date, factor, quintile, n, mean_score, n_outside)"""
        outside = F.abs("score") > WINSOR_LIMIT + SCORE_TOLERANCE
        found = self.tables.mart_scores_monthly.groupBy(*CROSS_SECTION, "quintile").agg(
            F.count("*").alias("n"), F.avg("score").alias("mean_score"), F.count_if(outside).alias("n_outside")
        )
        return self._keep(found, "quintiles")

    @cached_property
    def ticker_months(self) -> DataFrame:
        """One row: (n_repeated, n_extreme), keys that occur twice and ticker-months with an extreme
        return. Both groupings combine before the shuffle."""
        extreme = F.max(F.coalesce(F.abs("fwd_ret_1m") > EXTREME_RETURN, F.lit(False)).cast("int"))
        found = (
            self.tables.mart_scores_monthly.groupBy("ticker", *CROSS_SECTION)
            .agg(F.count("*").alias("n"), extreme.alias("extreme"))
            .groupBy("ticker", "rebalance_date")
            .agg(F.count_if(F.col("n") > 1).alias("repeated"), F.max("extreme").alias("extreme"))
            .agg(
                F.coalesce(F.sum("repeated"), F.lit(0)).alias("n_repeated"),
                F.coalesce(F.sum("extreme"), F.lit(0)).alias("n_extreme"),
            )
        )
        return self._keep(found, "ticker-months")

    @cached_property
    def summary(self) -> DataFrame:
        return self._keep(self.tables.mart_factor_summary, "summary")


def _told(row: DataFrame, name: str, severity: str, n_bad: str, text: str) -> DataFrame:
    """A check whose count is a column of a one-row frame."""
    detail = F.concat(F.col(n_bad).cast("string"), F.lit(f" {text}"))
    return _result(row, name, severity, F.col(n_bad), detail)


def duplicates(m: Measures) -> DataFrame:
    text = "duplicate (ticker, rebalance_date, factor) keys in mart_scores_monthly"
    return _told(m.ticker_months, "duplicates", "fail", "n_repeated", text)


def factor_coverage(m: Measures) -> DataFrame:
    sides = m.tables.dim_factor.select(F.lit(1).alias("dim"), F.lit(0).alias("mart")).unionByName(
        m.summary.select(F.lit(0).alias("dim"), F.lit(1).alias("mart"))
    )
    counts = sides.agg(F.sum("dim").alias("dim"), F.sum("mart").alias("mart"))
    detail = F.format_string("mart_factor_summary has %d factors, dim_factor has %d", F.col("mart"), F.col("dim"))
    return _result(counts, "factor_coverage", "fail", F.abs(F.col("mart") - F.col("dim")), detail)


def winsor_band(m: Measures) -> DataFrame:
    outside = m.quintiles.agg(F.coalesce(F.sum("n_outside"), F.lit(0)).alias("n_outside"))
    return _told(outside, "winsor_band", "fail", "n_outside", "scores outside the +/-3 band")


def quintile_balance(m: Measures) -> DataFrame:
    spread = m.quintiles.groupBy(*CROSS_SECTION).agg((F.max("n") - F.min("n")).alias("spread"))
    return _counted(spread.filter("spread > 1"), "quintile_balance", "fail", "factor-months with quintile sizes more than 1 apart")


def quintile_order(m: Measures) -> DataFrame:
    def mean_of(quintile: int) -> Column:
        return F.max(F.when(F.col("quintile") == quintile, F.col("mean_score")))

    ends = m.quintiles.groupBy(*CROSS_SECTION).agg(mean_of(QUINTILES).alias("top"), mean_of(1).alias("bottom"))
    return _counted(
        ends.filter("top <= bottom"),
        "quintile_order",
        "fail",
        "factor-months whose top quintile scores no higher than the bottom one",
    )


def extreme_returns(m: Measures) -> DataFrame:
    text = "ticker-months with a forward return beyond +/-80%: inspect them"
    return _told(m.ticker_months, "extreme_returns", "warn", "n_extreme", text)


def history_coverage(m: Measures) -> DataFrame:
    """Scored months against the calendar months that the raw prices span."""
    raw = m.tables.raw_prices.select(month_index(F.col("trade_date")).alias("raw_month"))
    # distinct months first: what reaches the single-row aggregate is one row per month
    scored = m.quintiles.select("rebalance_date").distinct()
    both = raw.agg((F.max("raw_month") - F.min("raw_month") + 1).alias("span"), F.lit(0).alias("scored")).unionByName(
        scored.agg(F.lit(0).alias("span"), F.count("*").alias("scored"))
    )
    counts = both.agg(F.sum("span").alias("span"), F.sum("scored").alias("scored"))
    thin = (F.col("scored") < HISTORY_SHARE * F.col("span")).cast("int")
    detail = F.format_string("%d of %d calendar months in the raw price range are scored", "scored", "span")
    return _result(counts, "history_coverage", "warn", thin, detail)


def thin_history(m: Measures) -> DataFrame:
    thin = m.summary.filter(F.col("n_months") < MIN_MONTHS)
    return _counted(thin, "thin_history", "warn", "factors with fewer than 24 monthly observations")


CHECKS: list[Callable[..., DataFrame]] = [
    duplicates,
    factor_coverage,
    winsor_band,
    quintile_balance,
    quintile_order,
    extreme_returns,
    history_coverage,
    thin_history,
]


def _empty_mart(quintiles: DataFrame) -> DataFrame:
    detail = F.lit("mart_scores_monthly is empty: universe, min_universe or history insufficient")
    return _result(quintiles.agg(F.count("*").alias("n")), "empty_mart", "fail", 1 - F.col("n"), detail)


def run_checks(tables) -> DataFrame:
    """(check, severity, n_bad, detail), one row per check. ``tables`` has the tables of a run as
    attributes. With an empty mart the only row says so. The mart is read twice, whatever the
    number of checks."""
    measures = Measures(tables, stored=True)
    if measures.quintiles.isEmpty():
        return _empty_mart(measures.quintiles)
    return reduce(DataFrame.unionByName, [check(measures) for check in CHECKS])


def messages(results: DataFrame) -> tuple[list[str], list[str]]:
    """(failures, warnings) as text, from the few rows of ``run_checks``."""
    bad = results.filter("n_bad > 0").collect()
    return tuple([row.detail for row in bad if row.severity == severity] for severity in ("fail", "warn"))


def mart_window(scores_monthly: DataFrame) -> DataFrame:
    """(first_month, last_month, n_months)"""
    return scores_monthly.agg(
        F.min("rebalance_date").alias("first_month"),
        F.max("rebalance_date").alias("last_month"),
        F.count_distinct("rebalance_date").alias("n_months"),
    )
