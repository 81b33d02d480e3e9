"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Factor, label, direction (+1: high raw value is good, -1: low), definition.
# The list order is the canonical display order.
FACTORS = [
    ("mom_12_1", "Momentum (12-1)", 1, "Price(t-21d) / Price(t-252d) - 1; skips most recent month"),
    ("rev_21d", "Short-term reversal (1M)", -1, "Price(t) / Price(t-21d) - 1; losers score high"),
    ("vol_63d", "Low volatility (63d)", -1, "Annualised stdev of daily returns over 63 obs; low vol scores high"),
    ("beta_252d", "Low beta (252d)", -1, "Beta vs equal-weight universe return over 252 obs; low beta scores high"),
]


def dim_factor(spark: SparkSession) -> DataFrame:
    """(factor, label, direction, definition)"""
    names = ("factor", "label", "direction", "definition")
    rows = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)]) for row in FACTORS]
    return spark.range(0, 1, 1, numPartitions=1).select(F.inline(F.array(*rows)))


def dim_month(scores_monthly: DataFrame) -> DataFrame:
    """(month_end, yr, mth): the months that have scores."""
    return (
        scores_monthly.select(F.col("rebalance_date").alias("month_end"))
        .distinct()
        .select("month_end", F.year("month_end").alias("yr"), F.month("month_end").alias("mth"))
    )


def canonical_position(factor: str = "factor"):
    """Sort key: canonical factors first in their order, unknown ones after them (by name)."""
    names = F.array(*[F.lit(name) for name, *_ in FACTORS])
    found = F.array_position(names, F.col(factor))
    return F.when(found > 0, found).otherwise(len(FACTORS) + 1).cast("int")
