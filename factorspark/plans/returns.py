"""Daily returns, market proxy and rebalance calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from factorspark.functions import growth, month_index
from factorspark.params import Params


def ticker_days() -> WindowSpec:
    """Rows of a ticker by day. The partition is bounded: the input contract leaves one row per
    (ticker, day), so it never holds more rows than the calendar has days."""
    return Window.partitionBy("ticker").orderBy("trade_date")


def daily_returns(prices: DataFrame, params: Params) -> DataFrame:
    """(ticker, trade_date, adj_close, ret_1d). Non-positive prices go first, so the gap is
    measured between the surviving rows; a return over too long a gap is NULL."""
    previous_close = F.lag("adj_close").over(ticker_days())
    previous_day = F.lag("trade_date").over(ticker_days())
    close_enough = F.datediff("trade_date", previous_day) <= params.max_gap_days
    return prices.filter(F.col("adj_close") > 0).select(
        "ticker",
        "trade_date",
        "adj_close",
        F.when(close_enough, growth(F.col("adj_close"), previous_close)).alias("ret_1d"),
    )


def market_proxy(returns: DataFrame, params: Params) -> DataFrame:
    """(trade_date, mkt_ret, n_names): equal-weight mean of the valid returns of a date."""
    return (
        returns.filter(F.col("ret_1d").isNotNull())
        .groupBy("trade_date")
        .agg(F.avg("ret_1d").alias("mkt_ret"), F.count("ret_1d").alias("n_names"))
        .filter(F.col("n_names") >= params.min_universe)
    )


def rebalance_dates(market: DataFrame) -> DataFrame:
    """(rebalance_date, month_idx): last market date of every month but the latest, which may be
    incomplete."""
    latest = market.select(F.max(month_index(F.col("trade_date")))).scalar()
    return (
        market.groupBy(month_index(F.col("trade_date")).alias("month_idx"))
        .agg(F.max("trade_date").alias("rebalance_date"))
        .filter(F.col("month_idx") < latest)
        .select("rebalance_date", "month_idx")
    )


def returns_vs_market(returns: DataFrame, market: DataFrame) -> DataFrame:
    """Returns with the market return of the date; the pair ``ret_b``, ``mkt_b`` is complete or
    NULL on both sides. The market has one row per calendar day, small enough to broadcast."""
    joined = returns.join(F.broadcast(market.select("trade_date", "mkt_ret")), "trade_date", "left")
    both = F.col("ret_1d").isNotNull() & F.col("mkt_ret").isNotNull()
    return joined.select(
        "ticker",
        "trade_date",
        "adj_close",
        "ret_1d",
        F.when(both, F.col("ret_1d")).alias("ret_b"),
        F.when(both, F.col("mkt_ret")).alias("mkt_b"),
    )
