"""The tables of a run, defined once.

``PLANS`` says how a table follows from other tables, which are the attributes of a run: a
``FactorRun`` composes them lazily, a catalog build stores them one after the other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from factorspark.params import Params
from factorspark.plans import dims, marts, returns, scores, signals


def _month_end(t, params: Params) -> DataFrame:
    """Month-end rows with signals and forward return. A lazy run computes the signals in this pass by
    ticker over the daily rows; where they are stored, only their month-end rows are read."""
    if t.signals_stored:
        found = scores.on_rebalance_dates(t.signals, t.rebalance_dates).drop("month_idx")
        prices = t.returns.select("ticker", "trade_date", "adj_close")
        rows = scores.on_rebalance_dates(prices, t.rebalance_dates).join(found, ["ticker", "rebalance_date"])
    else:
        rows = scores.on_rebalance_dates(signals.signal_rows(t.returns, t.market, by_ticker=True), t.rebalance_dates)
    return scores.with_forward_return(rows)


def ranked_scores(month_end: DataFrame, dim_factor: DataFrame, params: Params) -> DataFrame:
    """Scores of month-end rows with quintile and score rank: whole months give the rows of these months."""
    long = scores.unpivot_signals(month_end, scores.FORWARD)
    return marts.ranked_scores(scores.scores(long, dim_factor, params))


PLANS: dict[str, Callable[..., DataFrame]] = {
    "dim_factor": lambda t, p: dims.dim_factor(t.raw_prices.sparkSession),
    "returns": lambda t, p: returns.daily_returns(t.raw_prices, p),
    "market": lambda t, p: returns.market_proxy(t.returns, p),
    "rebalance_dates": lambda t, p: returns.rebalance_dates(t.market),
    "signals": lambda t, p: signals.signals(t.returns, t.market, by_ticker=True),
    "month_end": _month_end,
    "signals_long": lambda t, p: scores.unpivot_signals(t.month_end),
    "zscores": lambda t, p: scores.zscores(t.signals_long),
    "scores": lambda t, p: scores.scores(scores.unpivot_signals(t.month_end), t.dim_factor, p).select(
        "ticker", "rebalance_date", "factor", "raw_value", "n_names", "direction", "score"
    ),
    "fwd_returns": lambda t, p: t.month_end.select("ticker", "rebalance_date", scores.FORWARD),
    "ranked_scores": lambda t, p: ranked_scores(t.month_end, t.dim_factor, p),
    "mart_scores_monthly": lambda t, p: t.ranked_scores.drop(marts.RANK),
    "mart_factor_returns": lambda t, p: marts.mart_factor_returns(t.mart_scores_monthly),
    "mart_ic": lambda t, p: marts.mart_ic(t.ranked_scores),
    "mart_factor_summary": lambda t, p: marts.mart_factor_summary(t.mart_factor_returns, t.mart_ic),
    "dim_month": lambda t, p: dims.dim_month(t.mart_scores_monthly),
}
