"""Daily price panels derived from a trade table (``lineitem``: one row per traded line).

A trade table has no closing prices, so a panel is built from traded value and quantity per
supplier and day. All sums are integers (cents, units), which makes prices reproducible to the
last bit whatever the order of summation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorspark.functions import is_weekday
from factorspark.params import VOL_ROWS
from factorspark.sources.staging import tasks_for


def supplier_ticker(key: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad(key.cast("string"), 12, "0"))


def daily_trades(lineitem: DataFrame) -> DataFrame:
    """(ticker, trade_date, cents, units): weekday totals. Grouping combines map-side first, so a
    supplier holding a large share of all rows shuffles only its days."""
    return (
        lineitem.select(
            F.col("l_suppkey"),
            F.to_date("l_shipdate").alias("trade_date"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
            F.col("l_quantity").cast("bigint").alias("units"),
        )
        .filter(F.col("l_suppkey").isNotNull() & is_weekday(F.col("trade_date")))
        .groupBy("l_suppkey", "trade_date")
        .agg(F.sum("cents").alias("cents"), F.sum("units").alias("units"))
        .select(supplier_ticker(F.col("l_suppkey")).alias("ticker"), "trade_date", "cents", "units")
    )


def unit_price() -> Column:
    return F.col("cents").cast("double") / F.col("units").cast("double") / F.lit(100.0)


def sparse_panel(lineitem: DataFrame) -> DataFrame:
    """Only days that traded: irregular observations with calendar gaps."""
    traded = daily_trades(lineitem).filter(F.col("units") > 0)
    return traded.select("ticker", "trade_date", unit_price().alias("adj_close"))


def dense_rows(lineitem: DataFrame) -> int:
    """About the rows that ``dense_panel`` fills in: five sevenths of the days from each supplier's first
    trade to the last trade of the table. Grouping combines map-side, one row per supplier and task."""
    date = F.to_date("l_shipdate")
    counted = F.col("l_suppkey").isNotNull() & is_weekday(date)
    spans = lineitem.groupBy("l_suppkey").agg(
        F.min(F.when(counted, F.unix_date(date))).alias("first"), F.max(F.unix_date(date)).alias("last")
    )
    days = (F.max("last") + 1) * F.count("first") - F.sum("first")
    return spans.select(F.ceil(F.coalesce(days, F.lit(0)) * 5 / 7).alias("n")).first().n


def dense_panel(lineitem: DataFrame, rows: int = VOL_ROWS, size: int | None = None) -> DataFrame:
    """One row per ticker and weekday from its first trade to the last trade of the table; the
    price is value over quantity of the trailing ``rows`` weekdays.

    Running totals are taken over the traded days, then each day is repeated up to the next one, so
    the calendar is filled inside the ticker's own partition and without joining a calendar to
    every ticker. Totals of integers are exact: the trailing sum is a plain difference.

    A task fills far more rows than it reads, so the tickers are dealt by the number of filled rows:
    ``size`` if it is known, else ``dense_rows``, which reads the table now.
    """
    size = dense_rows(lineitem) if size is None else size
    tasks = tasks_for(size, lineitem.sparkSession.sparkContext.defaultParallelism)
    last_day = lineitem.select(F.max(F.to_date("l_shipdate"))).scalar()
    by_day = Window.partitionBy("ticker").orderBy("trade_date")
    running = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.date_sub(F.lead("trade_date").over(by_day), 1), last_day)
    totals = daily_trades(lineitem).repartition(tasks, "ticker").select(
        "ticker",
        *[F.sum(c).over(running).alias(c) for c in ("cents", "units")],
        F.sequence("trade_date", until).alias("days"),
    )
    filled = totals.select("ticker", "cents", "units", F.explode("days").alias("trade_date")).filter(
        is_weekday(F.col("trade_date"))
    )
    trailing = filled.select(
        "ticker",
        "trade_date",
        *[(F.col(c) - F.lag(c, rows, 0).over(by_day)).alias(c) for c in ("cents", "units")],
    )
    return trailing.filter(F.col("units") > 0).select("ticker", "trade_date", unit_price().alias("adj_close"))
