"""Inputs of the queries, all derived from the given tables."""

from __future__ import annotations

import re
import uuid
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorspark.functions import is_weekday
from factorspark.params import Params
from factorspark.plans import dims, marts, pipeline
from factorspark.plans.run import FactorRun
from factorspark.sources.catalog import Tables
from factorspark.sources.staging import run_folder, stage
from factorspark.sources.trades import dense_panel, dense_rows, sparse_panel, supplier_ticker, unit_price

PARAMS = Params(min_universe=5, max_gap_days=5, daily_buckets=8)


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def dense_rows(self) -> int:
        return dense_rows(self.table("lineitem"))

    def _dense_run(self, **window: int) -> FactorRun:
        panel = dense_panel(self.table("lineitem"), **window, size=self.dense_rows)
        return FactorRun(panel, PARAMS, self.dense_rows)

    @cached_property
    def run(self) -> FactorRun:
        return self._dense_run()

    @cached_property
    def sparse(self) -> DataFrame:
        return sparse_panel(self.table("lineitem"))

    @cached_property
    def gappy_run(self) -> FactorRun:
        """A price only where something traded in the last ten weekdays: rows with gaps, of which
        some windows pass the gates and some do not."""
        return self._dense_run(rows=10)

    @cached_property
    def quotes(self) -> DataFrame:
        """Every traded line as a raw quote in text, with padding, lower case, time parts, several
        date formats, unparseable dates and prices, and negative prices. Days repeat."""
        order = F.col("l_orderkey")
        ticker = supplier_ticker(F.col("l_suppkey"))
        day = F.date_format("l_shipdate", "yyyy-MM-dd")
        price = F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)").cast("string")
        return self.table("lineitem").select(
            F.when(F.col("l_linenumber") == 1, F.concat(F.lit("  "), F.lower(ticker), F.lit("\t")))
            .when(F.col("l_linenumber") == 2, F.lower(ticker))
            .when(order % 83 != 0, ticker)
            .alias("ticker"),
            F.when(order % 97 == 0, F.lit("n.d."))
            .when(order % 7 == 0, F.concat(day, F.lit(" 17:30:00")))
            .when(order % 11 == 0, F.date_format("l_shipdate", "yyyyMMdd"))
            .when(order % 13 == 0, F.date_format("l_shipdate", "MMM d, yyyy"))
            .when(order % 89 != 0, day)
            .alias("trade_date"),
            F.when(order % 101 == 0, F.lit("n/a"))
            .when(order % 103 == 0, F.concat(F.lit("-"), price))
            .when(order % 107 == 0, F.lit("NaN"))
            .otherwise(price)
            .alias("adj_close"),
        )

    @cached_property
    def near_duplicates(self) -> DataFrame:
        """The sparse panel with a second, slightly higher price in every other month."""
        again = self.sparse.filter(F.month("trade_date") % 2 == 0)
        return self.sparse.unionByName(again.withColumn("adj_close", F.col("adj_close") * F.lit(1 + 1e-7)))

    # star schema of a price store: every tenth supplier is a later version of the one before it

    @cached_property
    def dim_security(self) -> DataFrame:
        key = F.col("s_suppkey")
        original = F.when(key % 10 == 9, key - 1).otherwise(key)
        return self.table("supplier").select(key.alias("security_key"), supplier_ticker(original).alias("ticker"))

    @cached_property
    def dim_date(self) -> DataFrame:
        days = self.table("lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
        return days.select(_date_key("date"), "date", is_weekday(F.col("date")).alias("is_trading_day"))

    @cached_property
    def fact_prices(self) -> DataFrame:
        return (
            self.table("lineitem")
            .select(
                F.col("l_suppkey").alias("security_key"),
                F.to_date("l_shipdate").alias("date"),
                F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
                F.col("l_quantity").cast("bigint").alias("units"),
            )
            .groupBy("security_key", "date")
            .agg(F.sum("cents").alias("cents"), F.sum("units").alias("units"))
            .select("security_key", _date_key("date"), unit_price().alias("adj_close"))
        )

    @cached_property
    def built(self) -> Tables:
        """The run built and stored in a schema of this application."""
        pipeline.run(self.spark, dense_panel(self.table("lineitem")), self._stored)
        return Tables(self.spark, self._stored.schema)

    @cached_property
    def _stored(self) -> Params:
        name = f"build_{self.spark.sparkContext.applicationId}_{uuid.uuid4().hex[:8]}"
        return replace(PARAMS, schema=re.sub(r"\W", "_", name))

    @cached_property
    def rebuilt(self) -> Tables:
        """The stored run after two months of its marts were damaged and built again."""
        built = self.built
        months = [r.month_end for r in built.dim_month.filter("yr = 1997 AND mth IN (3, 8)").collect()]
        worse = built.mart_scores_monthly.filter(F.col("rebalance_date").isin(months) & (F.col("quintile") > 1))
        worse = stage(worse.withColumn("score", -F.col("score")), "worse")
        built.replace_partitions(worse, "mart_scores_monthly", months)
        for name in ("mart_factor_returns", "mart_ic"):
            built.materialize(getattr(built, name).filter(~F.col("rebalance_date").isin(months)), name)
        pipeline.rebuild_months(self.spark, self._stored, months)
        return built

    @cached_property
    def csv_folder(self) -> str:
        """The sparse panel as CSV. Lines of the 9th of a month lack the price, those of the 16th have
        a field more, those of the 23rd an open quote; tickers of the 27th are quoted, with a comma and
        quotes inside."""
        path = f"{run_folder(self.spark)}/csv-{uuid.uuid4().hex}"
        on = F.dayofmonth("trade_date")
        day = F.date_format("trade_date", "yyyy-MM-dd")
        line = (
            F.when(on == 9, F.concat_ws(",", "ticker", day))
            .when(on == 16, F.concat_ws(",", "ticker", day, F.lit("1"), F.lit("2")))
            .when(on == 23, F.concat(F.col("ticker"), F.lit(',"'), day, F.lit(",1")))
            .when(on == 27, F.concat(F.lit('"'), F.col("ticker"), F.lit(', ""b""",'), day, F.lit(","), F.col("adj_close").cast("string")))
            .otherwise(F.concat_ws(",", "ticker", day, F.col("adj_close").cast("string")))
        )
        # one column of finished lines, written as it is under the header of three
        lines = self.sparse.select(line.alias("ticker,trade_date,adj_close"))
        lines.write.option("header", True).option("sep", "\x01").option("quote", "\x00").csv(path)
        return path

    # altered copies of the marts, to have something to find

    @cached_property
    def restated(self) -> "Altered":
        """The run with restated scores: February dropped, the second and the fourth quintile of July
        merged, low-volatility scores stretched, some forward returns missing."""
        mart = self.run.mart_scores_monthly
        month = F.month("rebalance_date")
        missing = (F.col("factor") == "rev_21d") & (F.col("quintile") == 3)
        merged = (month == 7) & (F.col("quintile") == 4)
        changed = mart.filter(month != 2).select(
            "ticker",
            "rebalance_date",
            "factor",
            "raw_value",
            F.when(F.col("factor") == "vol_63d", F.col("score") * 1.04).otherwise(F.col("score")).alias("score"),
            F.when(merged, F.lit(2)).otherwise(F.col("quintile")).alias("quintile"),
            F.when(~missing, F.col("fwd_ret_1m")).alias("fwd_ret_1m"),
        )
        return Altered(self.run, changed)

    @cached_property
    def damaged(self) -> "Altered":
        """The run with faults in the mart: repeated rows, scores out of band, quintiles emptied
        and mirrored, extreme returns, a factor without history."""
        month = F.month("rebalance_date")
        mart = self.run.mart_scores_monthly
        changed = (
            mart.unionByName(mart.filter(month == 6))
            .filter((F.col("factor") != "beta_252d") | (F.col("rebalance_date") >= F.lit("2001-01-01").cast("date")))
            .withColumn("score", F.when(month == 5, F.col("score") * 4).otherwise(F.col("score")))
            .withColumn("quintile", F.when(month == 12, 6 - F.col("quintile")).otherwise(F.col("quintile")))
            .withColumn("quintile", F.when(month == 4, F.greatest(F.col("quintile"), F.lit(2))).otherwise(F.col("quintile")))
            .withColumn("fwd_ret_1m", F.col("fwd_ret_1m") * 5)
        )
        return Altered(self.run, changed)


class Altered:
    """A run whose marts are rebuilt from an altered mart_scores_monthly."""

    def __init__(self, run: FactorRun, scores_monthly: DataFrame):
        self._run = run
        self.mart_scores_monthly = stage(scores_monthly, "altered")
        self.mart_factor_returns = marts.mart_factor_returns(self.mart_scores_monthly)
        self.dim_month = dims.dim_month(self.mart_scores_monthly)

    @cached_property
    def mart_ic(self) -> DataFrame:
        return marts.mart_ic(self.mart_scores_monthly)

    @cached_property
    def mart_factor_summary(self) -> DataFrame:
        return marts.mart_factor_summary(self.mart_factor_returns, self.mart_ic)

    def __getattr__(self, name: str):
        return getattr(self._run, name)


def _date_key(day: str):
    return F.date_format(day, "yyyyMMdd").cast("int").alias("date_key")
