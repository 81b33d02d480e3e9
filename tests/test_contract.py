import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from factorspark.plans import contract
from factorspark.plans.contract import ContractError, validate
from factorspark.sources import staging

TEXT = "ticker string, trade_date string, adj_close string"
RAW = "ticker string, trade_date string, adj_close double"


def _frame(spark, rows, schema=RAW):
    return spark.createDataFrame(rows, schema)


def _message(df, **options):
    with pytest.raises(ContractError) as error:
        validate(df, **options)
    return str(error.value)


def test_clean_panel_is_normalised(spark):
    df = _frame(spark, [(" aapl", "2024-01-02", 10.0), ("AAPL\t\xa0\u2003", "2024-01-03", 10.5)])
    result = validate(df.withColumn("volume", F.lit(1)))
    assert result.frame.dtypes == [("ticker", "string"), ("trade_date", "date"), ("adj_close", "double")]
    assert result.deduped_groups == 0
    assert {tuple(r) for r in result.frame.collect()} == {
        ("AAPL", dt.date(2024, 1, 2), 10.0),
        ("AAPL", dt.date(2024, 1, 3), 10.5),
    }


def test_missing_column_raises_at_once(spark):
    df = _frame(spark, [("A", "2024-01-02", -1.0)]).drop("adj_close")
    assert _message(df).startswith("Missing required columns: the panel has no adj_close")


def test_every_violation_is_listed(spark):
    rows = [
        ("A", "2024-01-02", "1"),
        ("A", "2024-01-02", "1"),
        ("B", "2024-01-02", "-3"),
        (None, "2024-01-02", "1"),
        ("C", "soon", "1"),
        ("C", "2024-01-02", "n/a"),
    ]
    message = _message(_frame(spark, rows, TEXT))
    for part in (
        "ticker is null/unparseable in 1 rows",
        "trade_date is null/unparseable in 1 rows",
        "adj_close is null/unparseable in 1 rows",
        "adj_close <= 0 in 1 rows",
        "duplicate (ticker, trade_date) keys: 1",
    ):
        assert part in message
    assert message.count("; ") == 4


def test_report_has_every_rule_and_gives_the_message(spark):
    rows = [("A", "2024-01-02", "1"), ("A", "2024-01-02", "1.5"), ("B", "2024-01-02", "-3"), ("C", "soon", "1")]
    found = contract.report(contract.violations(contract.normalize(_frame(spark, rows, TEXT))), 1e-5).collect()
    assert [(r.rule, r.column, r.n_rows, r.worst, r.passes) for r in found] == [
        ("parseable", "ticker", 0, None, True),
        ("parseable", "trade_date", 1, None, False),
        ("parseable", "adj_close", 0, None, True),
        ("positive", "adj_close", 1, None, False),
        ("unique", "ticker, trade_date", 1, 0.5, False),
        ("not empty", None, 3, None, True),
    ]
    with pytest.raises(contract.ContractError) as error:
        contract.validate(_frame(spark, rows, TEXT), 1e-5)
    assert error.value.report == found
    assert str(error.value).count("; ") == sum(not r.passes for r in found) - 1
    wide = contract.report(contract.violations(contract.normalize(_frame(spark, rows, TEXT))), 0.5).collect()
    assert [r.passes for r in wide] == [True, False, True, False, True, True]


@pytest.mark.parametrize(
    "text, parsed",
    [
        ("1.5", 1.5),
        (" 2 ", 2.0),
        ("1e3", 1000.0),
        ("-.5", -0.5),
        ("inf", float("inf")),
        ("NaN", None),
        ("1.5d", None),
        ("0x1p3", None),
        ("1-2", None),
        ("1,5", None),
        ("", None),
        (None, None),
    ],
)
def test_number_parsing(spark, text, parsed):
    df = _frame(spark, [("A", "2024-01-02", text)], TEXT)
    assert contract.normalize(df).first().adj_close == parsed


@pytest.mark.parametrize(
    "text, parsed",
    [
        ("2024-01-02", dt.date(2024, 1, 2)),
        ("2024-01-02 23:30:00", dt.date(2024, 1, 2)),
        ("2024-01-02T23:30:00-05:00", dt.date(2024, 1, 2)),
        ("2024-02-30", None),
        ("tomorrow", None),
        ("20240102", dt.date(2024, 1, 2)),
        (" 2024/1/2 ", dt.date(2024, 1, 2)),
        ("Jan 2, 2024", dt.date(2024, 1, 2)),
        ("2 Jan 2024", dt.date(2024, 1, 2)),
        ("02-Jan-2024", dt.date(2024, 1, 2)),
        ("20241301", None),
        ("01/02/2024", None),  # could be January or February
    ],
)
def test_date_parsing(spark, text, parsed):
    df = _frame(spark, [("A", text, "1")], TEXT)
    assert contract.normalize(df).first().trade_date == parsed


def test_ambiguous_dates_on_request(spark):
    df = _frame(spark, [("A", "01/02/2024", "1"), ("B", "2024-03-04", "1"), ("C", "20240102", "1")], TEXT)
    found = {r.ticker: r.trade_date for r in contract.normalize(df, ["d/M/yyyy"]).collect()}
    assert found == {"A": dt.date(2024, 2, 1), "B": dt.date(2024, 3, 4), "C": None}


def test_what_is_loaded_is_what_was_counted(spark, tmp_path):
    path = str(tmp_path / "prices")
    _frame(spark, [("A", "2024-01-02", 1.0), ("B", "2024-01-02", 2.0)]).write.parquet(path)
    result = validate(spark.read.parquet(path))
    _frame(spark, [("C", "2024-01-02", -1.0)]).write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    assert {r.ticker for r in result.frame.collect()} == {"A", "B"}


def test_validation_counts_what_violations_count(spark):
    """Tickers in several spellings, and one key that holds a third of all rows, under four of them."""
    rng = random.Random(5)
    rows = [(rng.choice(["HOT", "hot ", "\thot", " Hot"]), "2024-01-02", str(100 + rng.random())) for _ in range(400)]
    rows += [
        (rng.choice(["a", " A", "b", "", None]), rng.choice(["2024-01-02", "20240102", "?"]), rng.choice(["x", "-1", "2", "3"]))
        for _ in range(800)
    ]
    df = _frame(spark, rows, TEXT).repartition(9)
    with pytest.raises(ContractError) as error:
        validate(df, 1e-5)
    assert error.value.report == contract.report(contract.violations(contract.normalize(df)), 1e-5).collect()
    rules = {(r.rule, r.column): r.n_rows for r in error.value.report}
    assert rules["unique", "ticker, trade_date"] == 4 and rules["not empty", None] > 400


def test_the_days_of_a_ticker_travel_together(spark):
    """One shuffle by ticker, and none before it where the source is dealt by ticker."""
    df = _frame(spark, [("A", "2024-01-02", 1.0), ("a ", "2024-01-03", 2.0), ("B", "2024-01-02", 2.0)])
    plan = contract._dealt_by_ticker(df.repartition(5, "ticker"))._jdf.queryExecution().executedPlan().toString()
    dealt = [line.split("hashpartitioning(")[1].split(")")[0] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert len(dealt) == 2 and all(keys.startswith("ticker#") and keys.count("#") == 1 for keys in dealt)
    assert {r.ticker for r in validate(df).frame.collect()} == {"A", "B"}


def test_tasks_of_validation_follow_the_panel_not_the_session(spark):
    """One partition in the session; the panel is validated and staged in several, and the settings come back."""
    keys = {"spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    others = [staging._FIRST_PARTITIONS, staging._PARTITION_SIZE]
    before = {key: spark.conf.get(key, None) for key in [*keys, *others]}
    days = spark.range(20_000).select(
        F.concat(F.lit("T"), F.col("id") % 200).alias("ticker"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 200).cast("int")).alias("trade_date"),
        (F.rand(3) + 1).alias("adj_close"),
    )
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        frame = validate(days).frame
        assert [spark.conf.get(key, None) for key in others] == [before[key] for key in others]
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1"
    finally:
        for key in keys:
            spark.conf.unset(key) if before[key] is None else spark.conf.set(key, before[key])
    assert len(frame.inputFiles()) > 1
    assert frame.count() == 20_000
    homes = frame.select("ticker", F.input_file_name().alias("file")).distinct()
    assert homes.count() == 200  # a ticker lies in one file


def test_only_the_panel_is_staged(spark):
    result = validate(_frame(spark, [("A", "2024-01-02", 1.0), ("A", "2024-01-02", 1.0), ("B", "2024-01-03", 2.0)]), 1e-5)
    (folder,) = {path.rsplit("/", 1)[0] for path in result.frame.inputFiles()}
    assert spark.read.parquet(folder).columns == ["ticker", "trade_date", "adj_close"]
    assert (result.deduped_groups, result.rows, result.frame.count()) == (1, 2, 2)


def test_timestamps_lose_their_time(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 2, 17, 30), 1)], "ticker string, trade_date timestamp, adj_close int")
    assert tuple(contract.normalize(df).first()) == ("A", dt.date(2024, 1, 2), 1.0)


def _duplicates(spark, spread):
    day = "2024-01-02"
    return _frame(spark, [("A", day, 100.0), ("A", day, 100.0 * (1 + spread)), ("B", day, 50.0)])


def test_duplicates_within_tolerance_collapse(spark):
    result = validate(_duplicates(spark, 1e-7), dup_rel_tol=1e-5)
    assert result.deduped_groups == 1
    assert {(r.ticker, r.adj_close) for r in result.frame.collect()} == {("A", 100.0), ("B", 50.0)}


def test_duplicates_beyond_tolerance_abort(spark):
    assert "exceeds tolerance" in _message(_duplicates(spark, 0.01), dup_rel_tol=1e-5)


def test_identical_duplicates_abort_without_tolerance(spark):
    message = _message(_duplicates(spark, 0.0))
    assert "duplicate" in message and "0.00e+00" in message and "tolerance" not in message


def test_undefined_spread_is_infinite(spark):
    day = "2024-01-02"
    df = _frame(spark, [("A", day, 0.0), ("A", day, 0.0)])
    message = _message(df, dup_rel_tol=1e-5)
    assert "adj_close <= 0 in 2 rows" in message and "inf" in message


def test_nothing_left_after_null_removal(spark):
    assert "no complete row" in _message(_frame(spark, [(None, "2024-01-02", 1.0)]))
    assert _message(_frame(spark, [])) == "the panel has no complete row"


def test_violations_against_brute_force(spark):
    """One key holds a third of all rows; counts equal a plain loop over the rows."""
    rng = random.Random(3)
    rows = [("HOT", "2024-01-02", 100.0 + rng.random()) for _ in range(400)]
    rows += [
        (rng.choice(["a", " B", None]), rng.choice(["2024-01-02", "2024-01-03", "?"]), rng.choice([None, -1.0, 2.0, 3.0]))
        for _ in range(800)
    ]
    found = contract.violations(contract.normalize(_frame(spark, rows).repartition(9))).first()
    clean = [(t and t.strip().upper(), None if d == "?" else d, p) for t, d, p in rows]
    complete = [r for r in clean if None not in r]
    groups = {}
    for t, d, p in complete:
        groups.setdefault((t, d), []).append(p)
    several = [g for g in groups.values() if len(g) > 1]
    assert found.null_ticker == sum(r[0] is None for r in clean)
    assert found.null_trade_date == sum(r[1] is None for r in clean)
    assert found.null_adj_close == sum(r[2] is None for r in clean)
    assert (found.complete_rows, found.duplicate_groups) == (len(complete), len(several))
    assert found.nonpositive == sum(r[2] <= 0 for r in complete)
    assert found.worst_spread == pytest.approx(max((max(g) - min(g)) / abs(min(g)) for g in several))


def test_profile(spark):
    frame = validate(_frame(spark, [("A", "2024-01-02", 1.0), ("B", "2024-01-05", 2.0), ("A", "2024-01-05", 1.0)])).frame
    assert tuple(contract.panel_profile(frame).first()) == (3, 2, dt.date(2024, 1, 2), dt.date(2024, 1, 5))
