"""One query per operator. Doubles are rounded so that the order of summation does not show."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorspark.plans import checks, contract, marts, parity, reporting, returns, scores
from factorspark.sources.catalog import Tables
from factorspark.sources.prices import BAD_LINE, consensus_prices, read_prices
from workload.inputs import Inputs

DIGITS = 6
# Prices come from integer sums and are the same to the last bit; rounding could split a tie.
EXACT = {"adj_close", "min_price", "max_price", "l_extendedprice"}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded (without a negative zero), integers as bigint."""

    def plain(column: str, dtype: str):
        if dtype == "double" and column not in EXACT:
            return (F.round(column, DIGITS) + F.lit(0.0)).alias(column)
        return F.col(column).cast("bigint").alias(column) if dtype == "int" else F.col(column)

    return df.select(*[plain(column, dtype) for column, dtype in df.dtypes])


def _one_signal(name: str) -> Callable[[Inputs], DataFrame]:
    return lambda i: i.run.signals.select("ticker", "trade_date", name)


def _check(check) -> Callable[[Inputs], DataFrame]:
    return lambda i: check(checks.Measures(i.run))


def _export(run: str, table: str) -> Callable[[Inputs], DataFrame]:
    return lambda i: reporting.export_table(getattr(getattr(i, run), table), reporting.EXPORTS[table])


def _from_csv(raw: DataFrame) -> DataFrame:
    """The normalised columns of every line, and the text of those that do not fit."""
    return contract.normalize(raw, keep=[BAD_LINE]).withColumnRenamed(BAD_LINE, "bad_line")


def _ad_hoc(built: Tables) -> DataFrame:
    built.register_views(["mart_factor_returns", "dim_factor"])
    return built.query(
        """SELECT D.Label, count(*) AS N_Months, count_if(F.LS_Ret > 0) AS N_Hits, max(F.LS_Ret) AS Best_Month
           FROM Mart_Factor_Returns F JOIN Dim_Factor D ON F.Factor = D.Factor GROUP BY D.Label"""
    )


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # sources and input contract
    "src_parquet": lambda i: read_prices(i.spark, parquet=f"{i.sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.to_date("l_shipdate").alias("ship_date"), "l_extendedprice"
    ),
    "src_csv": lambda i: _from_csv(read_prices(i.spark, csv=i.csv_folder)),
    "price_panel": lambda i: i.run.raw_prices,
    "price_panel_sparse": lambda i: i.sparse,
    "consensus_prices": lambda i: consensus_prices(i.fact_prices, i.dim_security, i.dim_date),
    "panel_profile": lambda i: contract.panel_profile(i.run.raw_prices),
    "contract_normalize": lambda i: contract.normalize(i.quotes),
    "contract_violations": lambda i: contract.violations(contract.normalize(i.quotes)),
    "contract_report": lambda i: contract.report(contract.violations(contract.normalize(i.quotes)), dup_rel_tol=1e-5),
    "contract_dup_groups": lambda i: contract.duplicate_groups(
        contract.normalize(consensus_prices(i.fact_prices, i.dim_security, i.dim_date))
    ),
    "contract_dedup": lambda i: contract.validate(i.near_duplicates, dup_rel_tol=1e-5).frame,
    # daily tables
    "daily_returns": lambda i: returns.daily_returns(i.run.raw_prices, i.run.params),
    "daily_returns_sparse": lambda i: returns.daily_returns(i.sparse, i.run.params),
    "market_proxy": lambda i: returns.market_proxy(i.run.returns, i.run.params),
    "returns_vs_market": lambda i: returns.returns_vs_market(i.run.returns, i.run.market),
    "signal_momentum": _one_signal("mom_12_1"),
    "signal_reversal": _one_signal("rev_21d"),
    "signal_volatility": _one_signal("vol_63d"),
    "signal_beta": _one_signal("beta_252d"),
    "signals": lambda i: i.run.signals,
    "signals_with_gaps": lambda i: i.gappy_run.signals,
    # cross-section
    "rebalance_dates": lambda i: i.run.rebalance_dates,
    "signals_long": lambda i: scores.signals_long(i.run.signals, i.run.rebalance_dates),
    "zscores": lambda i: i.run.zscores,
    "winsorized_scores": lambda i: i.run.scores.select("ticker", "rebalance_date", "factor", "score"),
    "scores": lambda i: i.run.scores,
    "forward_returns": lambda i: scores.forward_returns(i.run.returns, i.run.rebalance_dates),
    "forward_returns_with_gaps": lambda i: scores.forward_returns(i.gappy_run.returns, i.gappy_run.rebalance_dates),
    # marts
    "mart_scores_monthly": lambda i: i.run.mart_scores_monthly,
    "mart_factor_returns": lambda i: i.run.mart_factor_returns,
    "mart_ic": lambda i: i.run.mart_ic,
    "mart_factor_summary": lambda i: i.run.mart_factor_summary,
    "dim_month": lambda i: i.run.dim_month,
    "mart_window": lambda i: checks.mart_window(i.run.mart_scores_monthly),
    "run_manifest": lambda i: reporting.run_manifest(i.run),
    # invariants
    **{f"check_{check.__name__}": _check(check) for check in checks.CHECKS},
    "checks_damaged_run": lambda i: checks.run_checks(i.damaged),
    # comparison of two runs
    "parity_counts": lambda i: parity.parity_counts(i.run, i.restated),
    "parity_keys": lambda i: parity.key_sides(i.run.mart_scores_monthly, i.restated.mart_scores_monthly),
    "parity_summary": lambda i: parity.parity_summary(i.run.mart_factor_summary, i.restated.mart_factor_summary),
    "parity_rows": lambda i: parity.parity_rows(i.run.mart_scores_monthly, i.restated.mart_scores_monthly),
    "parity": lambda i: parity.parity(i.run, i.restated),
    # build in a catalog
    "pipeline_build": lambda i: i.built.mart_factor_summary,
    "pipeline_rebuild_month": lambda i: i.rebuilt.mart_scores_monthly,
    "scores_with_forward": lambda i: marts.scores_with_forward(i.built.scores, i.built.fwd_returns),
    "adhoc_sql": lambda i: _ad_hoc(i.built),
    # report and BI tables
    "export_factor_summary": _export("run", "mart_factor_summary"),
    "export_factor_returns": _export("damaged", "mart_factor_returns"),
    "factor_order": lambda i: reporting.factor_order(i.run.mart_factor_summary),
    "factor_tstats": lambda i: reporting.factor_tstats(i.run.mart_factor_summary),
    "factor_significance": lambda i: reporting.factor_significance(i.run.mart_factor_summary),
    "results_table": lambda i: reporting.results_table(i.run.mart_factor_summary, i.run.dim_factor),
    "ic_tstats": lambda i: reporting.ic_tstats(i.run.mart_ic),
    "ic_rolling_12m": lambda i: reporting.ic_rolling(i.run.mart_ic),
    "cumulative_spread": lambda i: reporting.cumulative_spread(i.run.mart_factor_returns),
    "cumulative_spread_spine": lambda i: reporting.cumulative_spread_spine(
        i.run.mart_factor_returns, i.run.dim_month, i.run.dim_factor
    ),
    "cumulative_spread_mean": lambda i: reporting.cumulative_spread_spine(
        i.run.mart_factor_returns, i.run.dim_month, i.run.dim_factor, per_factor=False
    ),
    "quintile_profile": lambda i: reporting.quintile_profile(i.run.mart_factor_returns),
    "factor_measures": lambda i: reporting.factor_measures(
        i.run.mart_factor_returns, i.run.mart_ic, start="1997-01-01", end="2000-12-31", by=["factor"]
    ),
    "factor_measures_total": lambda i: reporting.factor_measures(
        i.run.mart_factor_returns, i.run.mart_ic, factors=["rev_21d", "vol_63d"]
    ),
    "reconciliation": lambda i: reporting.reconciliation(
        i.run.mart_factor_returns, i.run.mart_ic, i.run.mart_factor_summary
    ),
    "star_view": lambda i: reporting.star_view(i.run.mart_factor_returns, i.run.dim_factor, i.run.dim_month),
    "star_orphans": lambda i: reporting.star_orphans(
        {
            "mart_factor_returns": i.run.mart_factor_returns,
            "mart_ic": i.run.mart_ic,
            "mart_scores_monthly": i.run.mart_scores_monthly,
        },
        i.run.dim_factor,
        i.run.dim_month,
    ),
}


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query):
        return lambda spark, sf_dir: comparable(query(Inputs(spark, sf_dir)))

    return {name: bind(query) for name, query in QUERIES.items()}
