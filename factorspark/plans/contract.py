"""Input contract: what a price panel must satisfy before anything is built on it."""

from __future__ import annotations

from dataclasses import dataclass

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from factorspark.functions import DATE_FORMATS, clean_ticker, parse_date, parse_number, ratio
from factorspark.sources.staging import fine, stage

REQUIRED = ("ticker", "trade_date", "adj_close")
# The phrases by which a caller tells the violations apart.
MISSING = "Missing required columns"
UNPARSEABLE = "null/unparseable"
NONPOSITIVE = "adj_close <= 0"
REPEATED = "duplicate (ticker, trade_date)"
INTOLERABLE = "exceeds tolerance"
KEYS = ["ticker", "trade_date"]


class ContractError(ValueError):
    """The panel breaks the contract; the message lists every violation, ``report`` has every rule."""

    def __init__(self, message: str, report: Sequence[Row] = ()):
        super().__init__(message)
        self.report = list(report)


@dataclass(frozen=True)
class ValidatedPrices:
    frame: DataFrame
    deduped_groups: int
    rows: int


def normalize(df: DataFrame, date_formats: Sequence[str] = DATE_FORMATS, keep: Sequence[str] = ()) -> DataFrame:
    """(ticker string, trade_date date, adj_close double): trimmed upper-case ticker, leniently
    parsed date and price; what cannot be parsed is NULL. Other columns are dropped but for ``keep``.

    Text dates are ISO, or in the first of ``date_formats`` that fits. The defaults cannot be
    mistaken for one another; formats such as ``d/M/yyyy`` have to be asked for."""
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ContractError(f"{MISSING}: the panel has no {', '.join(missing)}; its columns are {', '.join(df.columns)}")
    types = dict(df.dtypes)
    return df.select(
        clean_ticker(F.col("ticker")).alias("ticker"),
        parse_date(F.col("trade_date"), types["trade_date"], date_formats).alias("trade_date"),
        parse_number(F.col("adj_close"), types["adj_close"]).alias("adj_close"),
        *keep,
    )


def _per_key(normalized: DataFrame) -> DataFrame:
    """One row per (ticker, trade_date), NULL keys included. Rows combine map-side, so a key that
    repeats without end still shuffles as one row per task."""
    price = F.col("adj_close")
    return normalized.groupBy(*KEYS).agg(
        F.count("*").alias("n_rows"),
        F.count(price).alias("n_prices"),
        F.count_if(price <= 0).alias("n_nonpositive"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    )


def _dealt_by_ticker(df: DataFrame) -> DataFrame:
    """``_per_key`` of the normalised rows of ``df``, dealt by ticker alone.

    Rows combine per day and spelling of the ticker first: map-side, or without any shuffle where the source
    is dealt by ticker. So a key that repeats without end travels as one row per spelling, and the days of
    a ticker, which resemble one another, travel and lie together and take less disk."""
    normalized = normalize(df, keep=[F.col("ticker").cast("string").alias("_spelled")])
    parts = _per_key(normalized.select(F.col("_spelled").alias("ticker"), "trade_date", "adj_close"))
    named = parts.withColumn("ticker", clean_ticker(F.col("ticker")))
    return named.repartition("ticker").groupBy(*KEYS).agg(
        *[F.sum(name).alias(name) for name in ("n_rows", "n_prices", "n_nonpositive")],
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
    )


def _complete_key():
    return F.col("ticker").isNotNull() & F.col("trade_date").isNotNull()


def _spread():
    """(max - min) / |min|; NULL when that is undefined."""
    spread = ratio(F.col("max_price") - F.col("min_price"), F.abs("min_price"))
    return F.when(~F.isnan(spread), spread)


def duplicate_groups(normalized: DataFrame) -> DataFrame:
    """(ticker, trade_date, n_prices, min_price, max_price, spread) of keys with several prices."""
    return (
        _per_key(normalized)
        .filter(_complete_key() & (F.col("n_prices") > 1))
        .select(*KEYS, "n_prices", "min_price", "max_price", _spread().alias("spread"))
    )


def _totals() -> dict[str, Column]:
    """Aggregates over the keys."""
    complete = _complete_key()
    duplicated = complete & (F.col("n_prices") > 1)

    def total(condition: Column, rows: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(rows))), F.lit(0))

    return {
        "null_ticker": total(F.col("ticker").isNull(), "n_rows"),
        "null_trade_date": total(F.col("trade_date").isNull(), "n_rows"),
        "null_adj_close": F.coalesce(F.sum(F.col("n_rows") - F.col("n_prices")), F.lit(0)),
        "complete_rows": total(complete, "n_prices"),
        "nonpositive": total(complete, "n_nonpositive"),
        "duplicate_groups": F.count_if(duplicated),
        "worst_spread": F.max(F.when(duplicated, _spread())),
    }


def violations(normalized: DataFrame) -> DataFrame:
    """One row with every count the contract looks at: NULLs per column, complete rows, complete
    rows with a non-positive price, duplicate groups and their worst spread (NULL: undefined)."""
    return _per_key(normalized).agg(*[column.alias(name) for name, column in _totals().items()])


_COUNTS = (
    "null_ticker long, null_trade_date long, null_adj_close long, complete_rows long, nonpositive long, "
    "duplicate_groups long, worst_spread double"
)


def report(counts: DataFrame, dup_rel_tol: float | None = None) -> DataFrame:
    """(rule, column, n_rows, worst, passes): one row per rule of the contract, from ``violations``.

    ``n_rows`` are the rows against the rule; of ``unique`` the groups with several prices, with their
    worst relative spread in ``worst`` (NULL: undefined); of ``not empty`` the complete rows. Groups
    pass when their spread is within ``dup_rel_tol``."""
    within = F.lit(False) if dup_rel_tol is None else F.coalesce(F.col("worst_spread") <= dup_rel_tol, F.lit(False))
    rules = [("parseable", column, F.col(f"null_{column}"), None, F.col(f"null_{column}") == 0) for column in REQUIRED]
    rules += [
        ("positive", "adj_close", F.col("nonpositive"), None, F.col("nonpositive") == 0),
        ("unique", ", ".join(KEYS), F.col("duplicate_groups"), "worst_spread", (F.col("duplicate_groups") == 0) | within),
        ("not empty", None, F.col("complete_rows"), None, F.col("complete_rows") > 0),
    ]
    rows = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.lit(column).cast("string").alias("column"),
            n_rows.alias("n_rows"),
            (F.col(worst) if worst else F.lit(None).cast("double")).alias("worst"),
            passes.alias("passes"),
        )
        for rule, column, n_rows, worst, passes in rules
    ]
    return counts.select(F.inline(F.array(*rows)))


def _problem(rule: Row, dup_rel_tol: float | None) -> str:
    """What a rule that does not pass is called in the message."""
    if rule.rule == "parseable":
        return f"{rule.column} is {UNPARSEABLE} in {rule.n_rows} rows"
    if rule.rule == "positive":
        return f"{NONPOSITIVE} in {rule.n_rows} rows"
    if rule.rule == "unique":
        worst = float("inf") if rule.worst is None else rule.worst
        limit = "" if dup_rel_tol is None else f" and {INTOLERABLE} {dup_rel_tol:g}"
        return f"{REPEATED} keys: {rule.n_rows}, whose prices differ by up to {worst:.2e} of the lowest{limit}"
    return "the panel has no complete row"


def validate(df: DataFrame, dup_rel_tol: float | None = None) -> ValidatedPrices:
    """Normalised panel, or ContractError with all violations. With ``dup_rel_tol`` duplicate
    groups collapse when their worst relative price spread stays within it.

    The source is read once: its rows are combined per key and counted, and in the same job the panel is
    staged, without the counts per key. What was counted is what gets loaded, even if the source changes.
    Tasks follow the bytes of the panel, so that few partitions of the session do not make them spill.
    A valid panel without duplicates has one row per key, so the keys are the panel.
    """
    usable = _complete_key() & (F.col("n_prices") > 0)
    counted = Observation("panel")
    figures = _totals() | {"rows": F.count_if(usable)}
    per_key = _dealt_by_ticker(df).observe(counted, *[column.alias(name) for name, column in figures.items()])
    with fine(df.sparkSession):
        panel = stage(per_key.filter(usable).select(*KEYS, F.col("min_price").alias("adj_close")), "panel", small=True)
    seen = dict(counted.get)
    rows = seen.pop("rows")
    counts = df.sparkSession.createDataFrame([Row(**seen)], _COUNTS)
    rules = report(counts, dup_rel_tol).collect()
    found = [_problem(rule, dup_rel_tol) for rule in rules if not rule.passes]
    if found:
        raise ContractError("; ".join(found), rules)
    return ValidatedPrices(panel, seen["duplicate_groups"], rows)


def panel_profile(prices: DataFrame) -> DataFrame:
    """(n_rows, n_tickers, first_date, last_date)"""
    return prices.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("ticker").alias("n_tickers"),
        F.min("trade_date").alias("first_date"),
        F.max("trade_date").alias("last_date"),
    )
