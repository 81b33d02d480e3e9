"""Price sources. Each one yields the raw columns; the contract normalises them."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def query_text(query: str | None = None, query_file: str | None = None) -> str | None:
    """The query given inline or in a file, not both."""
    if query and query_file:
        raise ValueError("give either a query or a query file, not both")
    return Path(query_file).read_text(encoding="utf-8") if query_file else query


def jdbc_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. A single read sends the query as it is; a parallel one wraps it as a
    derived table, because Spark cannot split the ``query`` option."""
    options = {"url": url, "fetchsize": str(fetch_size)}
    if partition_column is None:
        return options | {"query": query}
    if bounds is None or num_partitions is None:
        raise ValueError("partition_column needs bounds and num_partitions")
    lower, upper = bounds
    return options | {
        "dbtable": f"({query.strip().rstrip(';')}) AS prices",
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(num_partitions),
    }


# Text of a line that does not fit the columns.
BAD_LINE = "_bad_line"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The columns of the header as text, and ``_bad_line``.

    Fields may be quoted and then hold commas, and quotes written twice. A line with too few or too many
    fields, or with a quote that is not closed, has NULL in all columns and its text in ``_bad_line``;
    the contract counts it as unparseable. Every file needs the same header."""
    names = spark.read.option("header", True).csv(path).columns
    fields = StructType([StructField(name, StringType()) for name in [*names, BAD_LINE]])
    reader = spark.read.schema(fields).option("columnNameOfCorruptRecord", BAD_LINE).option("mode", "PERMISSIVE")
    # a line is judged by all its fields, whatever columns are asked for
    reader = reader.option("columnPruning", False).option("header", True).option("enforceSchema", False)
    lines = reader.option("quote", '"').option("escape", '"').csv(path)
    fits = F.col(BAD_LINE).isNull()
    return lines.select(*[F.when(fits, F.col(f"`{name}`")).alias(name) for name in names], BAD_LINE)


def read_prices(
    spark: SparkSession,
    parquet: str | None = None,
    csv: str | None = None,
    jdbc_url: str | None = None,
    query: str | None = None,
    query_file: str | None = None,
    one_task: bool = False,
    **jdbc_split,
) -> DataFrame:
    """Read from exactly one of ``parquet``, ``csv`` and ``jdbc_url`` (which needs a query).
    CSV columns stay text, and damaged lines are kept beside them (``read_csv``). ``jdbc_split`` takes the partitioning arguments of ``jdbc_options``;
    reading a whole query in one task has to be asked for."""
    if sum(map(bool, (parquet, csv, jdbc_url))) != 1:
        raise ValueError("give exactly one of: parquet, csv, jdbc_url")
    statement = query_text(query, query_file)
    if parquet:
        return spark.read.parquet(parquet)
    if csv:
        return read_csv(spark, csv)
    if not statement:
        raise ValueError("jdbc_url needs a query")
    if "partition_column" not in jdbc_split and not one_task:
        raise ValueError("without partition_column the whole query is read in one task; split it or set one_task")
    return spark.read.format("jdbc").options(**jdbc_options(jdbc_url, statement, **jdbc_split)).load()


def consensus_prices(fact: DataFrame, dim_security: DataFrame, dim_date: DataFrame) -> DataFrame:
    """(ticker, trade_date, adj_close) of a price fact on trading days.

    Several security keys of a slowly-changing dimension can share a ticker, which yields several
    rows per (ticker, date); the contract decides about those. How to join the dimensions is left to
    their measured size.
    """
    trading_days = dim_date.filter("is_trading_day").select("date_key", F.col("date").alias("trade_date"))
    return (
        fact.join(trading_days, "date_key")
        .join(dim_security.select("security_key", "ticker"), "security_key")
        .select("ticker", "trade_date", "adj_close")
    )
