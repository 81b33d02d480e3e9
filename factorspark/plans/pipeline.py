"""Build of all tables in a catalog schema, stage by stage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from factorspark.params import Params
from factorspark.plans import checks
from factorspark.plans.contract import panel_profile, validate
from factorspark.plans.marts import mart_factor_returns, mart_ic
from factorspark.plans.signals import SIGNALS
from factorspark.plans.tables import PLANS, ranked_scores
from factorspark.sources.catalog import Tables
from factorspark.sources.staging import discard, frugal, scope, stage, stage_alone, tasks_for

# Names of the stages and of their tables, in build order. Every table reads only
# earlier ones. Scores and marts come from ``month_end``.
STAGES = {
    "dims": ["dim_factor"],
    "returns": ["returns"],
    "market": ["market", "rebalance_dates"],
    "signals": ["signals"],
    "month_end": ["month_end"],
    "scores": ["scores"],
    "fwd_returns": ["fwd_returns"],
    "marts": ["mart_scores_monthly", "mart_factor_returns", "mart_ic", "mart_factor_summary", "dim_month"],
}
# how tables are stored: in buckets, so that windows and joins over the key need no shuffle, or in a
# folder per month, so that some months can be read and renewed alone
_BUCKETS = {
    "returns": ["ticker"],
    "signals": ["ticker"],
    "scores": ["ticker", "rebalance_date"],
    "fwd_returns": ["ticker", "rebalance_date"],
}
# the table whose rows give the number of buckets, and how many rows follow from one of them at most;
# scores and forward returns are joined by bucket, so they share a number
_SIZED_BY = {
    "returns": ("raw_prices", 1),
    "signals": ("returns", 1),
    "scores": ("month_end", len(SIGNALS)),
    "fwd_returns": ("month_end", len(SIGNALS)),
}
_MONTHLY = ("month_end", "mart_scores_monthly")


class _Working:
    """Stored tables, and the ranked scores, which are staged for the marts and not stored."""

    def __init__(self, tables: Tables, params: Params, ranked: DataFrame | None = None):
        self._tables, self._params, self._ranked = tables, params, ranked

    @property
    def ranked_scores(self) -> DataFrame:
        if self._ranked is None:
            spark = self._tables.month_end.sparkSession
            self._ranked = stage_alone(
                spark, lambda: PLANS["ranked_scores"](self, self._params), "ranked_scores", small=True
            )
        return self._ranked

    def __getattr__(self, name: str):
        return getattr(self._tables, name)


@dataclass(frozen=True)
class RunReport:
    """What a run did: collapsed duplicate groups, profile of the loaded panel (one row), scored
    months (one row), and the messages of the checks."""

    deduped_groups: int
    profile: Row
    window: Row
    failures: list[str]
    warnings: list[str]


def _buckets(tables: Tables, name: str, params: Params) -> int | None:
    if name not in _BUCKETS:
        return None
    source, times = _SIZED_BY[name]
    return tasks_for(getattr(tables, source).count() * times, params.daily_buckets)


def build(spark: SparkSession, params: Params, stages: Sequence[str] | None = None) -> list[str]:
    """Run the named stages, or all, over the loaded ``raw_prices``; returns what ran.

    Daily tables are stored in buckets by ticker, the key of all their windows, which therefore read them
    without a shuffle; scores and forward returns in buckets by (ticker, date), the key of their join;
    month-end rows and the scores mart in a folder per month. There are ``params.daily_buckets`` buckets,
    more where a bucket would hold over ``TASK_ROWS`` rows. No table leaves its shuffle files behind."""
    unknown = set(stages or ()) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}; known: {list(STAGES)}")
    tables = Tables(spark, params.schema)
    tables.ensure_schema()
    ran = [step for step in STAGES if stages is None or step in stages]
    with scope(spark), frugal(spark):
        working = _Working(tables, params)
        for name in (name for step in ran for name in STAGES[step]):
            month = "rebalance_date" if name in _MONTHLY else None
            plan, buckets = PLANS[name](working, params), _buckets(tables, name, params)
            tables.materialize(plan, name, _BUCKETS.get(name), buckets, month)
    return ran


def rebuild_months(spark: SparkSession, params: Params, months: Sequence[dt.date]) -> None:
    """Build the marts of some rebalance dates again, from their stored month-end rows.

    A month's scores, quintiles and ranks depend on that month alone, so only its folders of ``month_end``
    are read and only its folders of the scores mart are written. The tables with a row per month and
    factor keep their other rows; the summary and the months follow from them."""
    tables = Tables(spark, params.schema)
    wanted = F.col("rebalance_date").isin(list(months))
    with scope(spark):
        month_end = tables.month_end.filter(wanted)
        ranked = stage(ranked_scores(month_end, tables.dim_factor, params), "ranked_scores")
        fresh = _Working(tables, params, ranked)
        mart = PLANS["mart_scores_monthly"](fresh, params)
        tables.replace_partitions(mart, "mart_scores_monthly", months)
        for name, rows in (("mart_factor_returns", mart_factor_returns(mart)), ("mart_ic", mart_ic(ranked))):
            tables.materialize(getattr(tables, name).filter(~wanted).unionByName(rows), name)
        for name in ("mart_factor_summary", "dim_month"):
            tables.materialize(PLANS[name](tables, params), name)


def run(spark: SparkSession, prices: DataFrame, params: Params, dup_rel_tol: float | None = None) -> RunReport:
    """Validate, load, build and check. The validated panel is removed once it is loaded, what else was staged
    on the way at the end."""
    tables = Tables(spark, params.schema)
    with scope(spark), frugal(spark):
        valid = validate(prices, dup_rel_tol)
        tables.load_prices(valid.frame, tasks_for(valid.rows, params.daily_buckets))
        discard(valid.frame)
        build(spark, params)
        failures, warnings = checks.messages(checks.run_checks(tables))
        return RunReport(
            valid.deduped_groups,
            panel_profile(tables.raw_prices).first(),
            checks.mart_window(tables.mart_scores_monthly).first(),
            failures,
            warnings,
        )
