"""Cross-sectional scores and forward returns on rebalance dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factorspark.functions import growth, ratio, winsorised
from factorspark.params import Params
from factorspark.plans.signals import SIGNALS

CROSS_SECTION = ["rebalance_date", "factor"]
FORWARD = "fwd_ret_1m"


def on_rebalance_dates(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """The rows on rebalance dates, with ``rebalance_date`` and ``month_idx`` for ``trade_date``.
    The calendar has one row per month and is broadcast."""
    days = F.broadcast(calendar.withColumnRenamed("rebalance_date", "trade_date"))
    return daily.join(days, "trade_date").withColumnRenamed("trade_date", "rebalance_date")


def unpivot_signals(month_end: DataFrame, *carry: str) -> DataFrame:
    """One row per valid signal: (ticker, rebalance_date, ``carry``, factor, raw_value)."""
    ids = ["ticker", "rebalance_date", *carry]
    return month_end.unpivot(ids, list(SIGNALS), "factor", "raw_value").filter(F.col("raw_value").isNotNull())


def signals_long(signals: DataFrame, calendar: DataFrame) -> DataFrame:
    """(ticker, rebalance_date, factor, raw_value): valid signals on rebalance dates. Only
    month-end rows are unpivoted."""
    return unpivot_signals(on_rebalance_dates(signals, calendar))


def zscores(long: DataFrame) -> DataFrame:
    """Add ``n_names`` and ``z_raw`` per (rebalance_date, factor); other columns are kept.

    Mean and deviation are aggregated map-side and joined back (months x factors rows, broadcast),
    so the rows themselves are not shuffled and a cross-section is never gathered in one task.
    """
    stats = long.groupBy(*CROSS_SECTION).agg(
        F.count("*").alias("n_names"), F.avg("raw_value").alias("_mean"), F.stddev_samp("raw_value").alias("_sd")
    )
    z = ratio(F.col("raw_value") - F.col("_mean"), F.col("_sd"))
    return long.join(F.broadcast(stats), CROSS_SECTION).withColumn("z_raw", z).drop("_mean", "_sd")


def scores(long: DataFrame, dim_factor: DataFrame, params: Params) -> DataFrame:
    """Add n_names, direction and score to (ticker, rebalance_date, factor, raw_value): clamp
    first, then apply the direction, so that a higher score is always better."""
    usable = zscores(long).filter(F.col("z_raw").isNotNull() & (F.col("n_names") >= params.min_universe))
    score = winsorised(F.col("z_raw")) * F.col("direction")
    directions = F.broadcast(dim_factor.select("factor", "direction"))
    return usable.join(directions, "factor").withColumn("score", score).drop("z_raw")


def with_forward_return(month_end: DataFrame) -> DataFrame:
    """Add ``fwd_ret_1m``: return to the ticker's next month-end row, NULL unless that is in the
    very next month."""
    by_month = Window.partitionBy("ticker").orderBy("rebalance_date")
    consecutive = F.lead("month_idx").over(by_month) == F.col("month_idx") + 1
    earned = growth(F.lead("adj_close").over(by_month), F.col("adj_close"))
    return month_end.withColumn(FORWARD, F.when(consecutive, earned))


def forward_returns(returns: DataFrame, calendar: DataFrame) -> DataFrame:
    """(ticker, rebalance_date, fwd_ret_1m)"""
    month_end = on_rebalance_dates(returns.select("ticker", "trade_date", "adj_close"), calendar)
    return with_forward_return(month_end).select("ticker", "rebalance_date", FORWARD)
