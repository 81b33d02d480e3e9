"""All tables over one price panel, composed lazily."""

from __future__ import annotations

from pyspark.sql import DataFrame

from factorspark.params import Params
from factorspark.plans.contract import REQUIRED
from factorspark.plans.returns import daily_returns
from factorspark.plans.tables import PLANS
from factorspark.sources.staging import discard, stage, stage_bucketed, tasks_for

# tables with several consumers; they are written once and read back
STAGED = ("market", "month_end", "ranked_scores")


class FactorRun:
    """Every table of a run as an attribute. Tables with several consumers are staged; the rest
    stays lazy, so asking for one table computes only what it needs.

    The prices are dealt by ticker once. The returns are staged in buckets by ticker, a layout that the
    catalog keeps, so the windows of the signals read them without a second exchange. The number of
    buckets follows from the number of prices: ``rows`` if it is known at least about, else they are
    staged and counted first."""

    signals_stored = False

    def __init__(self, raw_prices: DataFrame, params: Params, rows: int | None = None):
        self.raw_prices = raw_prices
        self.params = params
        self._rows = rows

    def _returns(self) -> DataFrame:
        if self._rows is not None:
            return self._dealt(self.raw_prices, self._rows)
        prices = stage(self.raw_prices.select(*REQUIRED), "prices")
        found = self._dealt(prices, prices.count())
        discard(prices)
        return found

    def _dealt(self, prices: DataFrame, rows: int) -> DataFrame:
        buckets = tasks_for(rows, self.params.daily_buckets)
        dealt = daily_returns(prices.repartition(buckets, "ticker"), self.params)
        return stage_bucketed(dealt, "returns", ["ticker"], buckets)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in PLANS:
            raise AttributeError(name)
        if name == "returns":
            found = self._returns()
        else:
            table = PLANS[name](self, self.params)
            found = stage(table, name) if name in STAGED else table
        setattr(self, name, found)
        return found
