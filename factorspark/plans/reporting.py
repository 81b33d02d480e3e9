"""Report and BI tables on top of the marts. All inputs are month-grain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from factorspark.functions import ratio, significant
from factorspark.params import MONTHS_PER_YEAR, QUINTILES
from factorspark.plans.dims import canonical_position
from factorspark.plans.marts import ic_statistics, spread_statistics

# Fixed values: |t| from which a statistic counts as different from zero; months of the trailing
# mean; the exported tables with their sort columns.
SIGNIFICANT_T = 2.0
TRAILING_MONTHS = 12
EXPORTS = {
    "mart_factor_summary": ["factor"],
    "mart_factor_returns": ["factor", "rebalance_date"],
    "mart_ic": ["factor", "rebalance_date"],
    "dim_factor": ["factor"],
}


def _factor_months() -> WindowSpec:
    return Window.partitionBy("factor").orderBy("rebalance_date")


# --- factor statistics ------------------------------------------------------------------------


def _tstats() -> dict[str, Column]:
    months = F.col("n_months")
    return {"t_ls": F.col("ls_sharpe") * F.sqrt(months / MONTHS_PER_YEAR), "t_ic": F.col("icir") * F.sqrt(months)}


def factor_tstats(summary: DataFrame) -> DataFrame:
    """(factor, n_months, t_ls, t_ic): naive t-statistics from Sharpe ratio and ICIR."""
    return summary.select("factor", "n_months", *[column.alias(name) for name, column in _tstats().items()])


def factor_significance(summary: DataFrame) -> DataFrame:
    """Adds ``verdict``: spread, ic_only or flat; NULL when a needed t-statistic is missing."""
    spread, ic = F.abs("t_ls") >= SIGNIFICANT_T, F.abs("t_ic") >= SIGNIFICANT_T
    verdict = F.when(spread, "spread").when(~spread & ic, "ic_only").when(~spread & ~ic, "flat")
    return factor_tstats(summary).withColumn("verdict", verdict)


def _position() -> Column:
    """Canonical order, unknown factors last by name. The frame has one row per factor."""
    return F.row_number().over(Window.orderBy(canonical_position(), "factor"))


def factor_order(dim_factor: DataFrame) -> DataFrame:
    """(factor, position) in display order."""
    return dim_factor.select("factor", _position().alias("position"))


def results_table(summary: DataFrame, dim_factor: DataFrame) -> DataFrame:
    """Display table: labels, percentages, t-statistics and the display position."""
    return (
        summary.withColumns({**_tstats(), "position": _position()})
        .join(F.broadcast(dim_factor.select("factor", "label")), "factor", "left")
        .select(
            "position",
            F.coalesce("label", "factor").alias("label"),
            F.col("n_months").alias("months"),
            (F.col("ann_ls_return") * 100).alias("ann_ls_return_pct"),
            (F.col("ann_ls_vol") * 100).alias("ann_ls_vol_pct"),
            "ls_sharpe",
            (F.col("hit_rate") * 100).alias("hit_rate_pct"),
            "mean_ic",
            "icir",
            "t_ls",
            "t_ic",
        )
    )


def ic_tstats(ic: DataFrame) -> DataFrame:
    """(factor, n_months, mean_ic, t_ic): naive t of the mean IC."""
    t = ratio(F.avg("ic"), F.stddev_samp("ic")) * F.sqrt(F.count("*"))
    return ic.groupBy("factor").agg(F.count("*").alias("n_months"), F.avg("ic").alias("mean_ic"), t.alias("t_ic"))


def quintile_profile(factor_returns: DataFrame) -> DataFrame:
    """(factor, quintile, mean_ret): mean forward return per quintile."""
    columns = {f"q{q}_ret": q for q in range(1, QUINTILES + 1)}
    long = factor_returns.unpivot("factor", list(columns), "bucket", "ret")
    return long.groupBy("factor", F.substring("bucket", 2, 1).cast("int").alias("quintile")).agg(
        F.avg("ret").alias("mean_ret")
    )


# --- series -----------------------------------------------------------------------------------


def ic_rolling(ic: DataFrame, months: int = TRAILING_MONTHS) -> DataFrame:
    """Adds ``ic_mean_12m``: mean of the last 12 ICs, NULL until there are 12."""
    trailing = _factor_months().rowsBetween(1 - months, Window.currentRow)
    full = F.count("ic").over(trailing) == months
    return ic.select("rebalance_date", "factor", "ic", F.when(full, F.avg("ic").over(trailing)).alias("ic_mean_12m"))


def cumulative_spread(factor_returns: DataFrame) -> DataFrame:
    """(rebalance_date, factor, ls_ret, cum_spread): spread compounded monthly; NULL in a month
    without a spread, which leaves the months after it unaffected."""
    so_far = _factor_months().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    growth = F.product(1 + F.col("ls_ret")).over(so_far) - 1
    return factor_returns.select(
        "rebalance_date", "factor", "ls_ret", F.when(F.col("ls_ret").isNotNull(), growth).alias("cum_spread")
    )


def cumulative_spread_spine(
    factor_returns: DataFrame,
    dim_month: DataFrame,
    dim_factor: DataFrame,
    factors: Sequence[str] | None = None,
    per_factor: bool = True,
) -> DataFrame:
    """(month_end, factor, cum_spread) for every month and factor of the dimensions, and for factors
    that only the returns have; a month without data is neutral. With ``per_factor=False`` the
    monthly mean over the selected factors is compounded instead (what the measure shows without a
    factor slicer; ``factor`` is then "all"). The names of the factors come to the driver."""
    if factors is None:
        known = dim_factor.select("factor").unionByName(factor_returns.select("factor")).distinct()
        names = [row.factor for row in known.orderBy("factor").collect()]
    else:
        names = list(factors)
    chosen = factor_returns.filter(F.col("factor").isin(names))
    if not per_factor:
        chosen, names = chosen.withColumn("factor", F.lit("all")), ["all"]
    monthly = chosen.groupBy("factor", F.col("rebalance_date").alias("month_end")).agg(F.avg("ls_ret").alias("ls_ret"))
    spine = dim_month.select("month_end", F.explode(F.array(*[F.lit(n) for n in names])).alias("factor"))
    so_far = Window.partitionBy("factor").orderBy("month_end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    growth = F.coalesce(1 + F.col("ls_ret"), F.lit(1.0))
    return spine.join(monthly, ["factor", "month_end"], "left").select(
        "month_end", "factor", (F.product(growth).over(so_far) - 1).alias("cum_spread")
    )


# --- BI measures ------------------------------------------------------------------------------


def factor_measures(
    factor_returns: DataFrame,
    ic: DataFrame,
    factors: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """The BI measures under a factor and date filter, over all selected rows or per ``by``.
    Both facts are stacked, so one aggregation serves them without a join."""
    stacked = factor_returns.select(
        "rebalance_date", "factor", "ls_ret", F.lit(None).cast("double").alias("ic"), F.lit(1).alias("is_return")
    ).unionByName(
        ic.select("rebalance_date", "factor", F.lit(None).cast("double").alias("ls_ret"), "ic", F.lit(0).alias("is_return"))
    )
    if factors is not None:
        stacked = stacked.filter(F.col("factor").isin(list(factors)))
    if start is not None:
        stacked = stacked.filter(F.col("rebalance_date") >= F.lit(start).cast("date"))
    if end is not None:
        stacked = stacked.filter(F.col("rebalance_date") <= F.lit(end).cast("date"))
    columns: dict[str, Column] = {
        "ls_return_month": F.avg("ls_ret"),
        **spread_statistics(),
        "hit_rate": ratio(F.count_if(F.col("ls_ret") > 0), F.sum("is_return")),
        **ic_statistics(),
    }
    return stacked.groupBy(*by).agg(*[c.alias(name) for name, c in columns.items()])


def reconciliation(factor_returns: DataFrame, ic: DataFrame, summary: DataFrame) -> DataFrame:
    """(factor, measure, diff): measures recomputed per factor minus the stored summary, about 0."""
    names = [c for c in summary.columns if c not in ("factor", "n_months")]
    measured = factor_measures(factor_returns, ic, by=["factor"]).alias("m")
    differences = [(F.col(f"m.{c}") - F.col(f"s.{c}")).alias(c) for c in names]
    joined = measured.join(summary.alias("s"), "factor").select("factor", *differences)
    return joined.unpivot("factor", names, "measure", "diff")


# --- star schema ------------------------------------------------------------------------------


def star_view(fact: DataFrame, dim_factor: DataFrame, dim_month: DataFrame) -> DataFrame:
    """A month-grain fact with factor label and calendar columns. Both dimensions are bounded (one
    row per factor, one per month) and broadcast."""
    months = F.broadcast(dim_month.withColumnRenamed("month_end", "rebalance_date"))
    return fact.join(F.broadcast(dim_factor), "factor").join(months, "rebalance_date")


def star_orphans(facts: dict[str, DataFrame], dim_factor: DataFrame, dim_month: DataFrame) -> DataFrame:
    """(fact, missing_factor, missing_month): fact rows without a dimension row; all zero."""

    def orphans(name: str, fact: DataFrame) -> DataFrame:
        known_factor = F.broadcast(dim_factor.select("factor", F.lit(1).alias("has_factor")))
        known_month = F.broadcast(dim_month.select(F.col("month_end").alias("rebalance_date"), F.lit(1).alias("has_month")))
        linked = fact.select("factor", "rebalance_date").join(known_factor, "factor", "left")
        return linked.join(known_month, "rebalance_date", "left").agg(
            F.lit(name).alias("fact"),
            F.count_if(F.col("has_factor").isNull()).alias("missing_factor"),
            F.count_if(F.col("has_month").isNull()).alias("missing_month"),
        )

    return reduce(DataFrame.unionByName, [orphans(name, fact) for name, fact in facts.items()])


# --- export -----------------------------------------------------------------------------------


def run_manifest(tables) -> DataFrame:
    """(item, value) as text: raw rows, tickers and dates, scored window, rows per exported table."""
    raw = tables.raw_prices.agg(
        F.count("*").alias("raw_rows"),
        F.count_distinct("ticker").alias("raw_tickers"),
        F.min("trade_date").alias("raw_first"),
        F.max("trade_date").alias("raw_last"),
    )
    # one pass per table
    more = {
        "mart_factor_returns": [
            F.min("rebalance_date").alias("scored_first"),
            F.max("rebalance_date").alias("scored_last"),
        ],
        "mart_ic": [F.count_distinct("rebalance_date").alias("scored_months")],
    }
    rows = [getattr(tables, t).agg(F.count("*").alias(f"rows_{t}"), *more.get(t, ())) for t in EXPORTS]

    def as_items(row: DataFrame) -> DataFrame:
        text = row.select(*[F.col(c).cast("string") for c in row.columns])
        return text.unpivot([], text.columns, "item", "value")

    return reduce(DataFrame.unionByName, [as_items(row) for row in (raw, *rows)])


def export_table(table: DataFrame, sort: Sequence[str]) -> DataFrame:
    """Sorted, with doubles at ten significant digits."""
    rounded = [significant(F.col(c)).alias(c) if dtype == "double" else F.col(c) for c, dtype in table.dtypes]
    return table.select(*rounded).orderBy(*sort)


def export_marts(tables, out: str) -> list[str]:
    """Write the four small marts and the manifest as CSV, one file per folder under ``out``.
    They hold at most a row per factor and month, so a single output file is bounded."""
    exports = {name: export_table(getattr(tables, name), sort) for name, sort in EXPORTS.items()}
    exports["manifest"] = run_manifest(tables).orderBy("item")
    for name, sorted_rows in exports.items():
        sorted_rows.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out}/{name}")
    return [f"{out}/{name}" for name in exports]
