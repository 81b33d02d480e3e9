import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from panels import PANEL
from factorspark.sources import staging
from factorspark.plans import contract
from factorspark.sources.catalog import LoadError, Tables
from factorspark.sources.prices import consensus_prices, jdbc_options, query_text, read_prices
from factorspark.sources.trades import dense_panel, dense_rows, sparse_panel


def test_exactly_one_source(spark):
    for given in ({}, {"parquet": "a", "csv": "b"}, {"csv": "b", "jdbc_url": "c", "query": "q"}):
        with pytest.raises(ValueError, match="exactly one"):
            read_prices(spark, **given)


def test_jdbc_needs_one_query(spark, tmp_path):
    with pytest.raises(ValueError, match="needs a query"):
        read_prices(spark, jdbc_url="jdbc:postgresql://host/db")
    path = tmp_path / "q.sql"
    path.write_text("SELECT 1")
    assert query_text(query_file=str(path)) == "SELECT 1"
    with pytest.raises(ValueError, match="not both"):
        read_prices(spark, jdbc_url="jdbc:postgresql://host/db", query="SELECT 2", query_file=str(path))


def test_jdbc_in_one_task_has_to_be_asked_for(spark):
    with pytest.raises(ValueError, match="one task"):
        read_prices(spark, jdbc_url="jdbc:postgresql://host/db", query="SELECT 1")


def test_jdbc_options():
    single = jdbc_options("jdbc:x", "SELECT 1")
    assert single["query"] == "SELECT 1" and "dbtable" not in single
    split = jdbc_options("jdbc:x", "SELECT 1;", "trade_date", ("2009-01-01", "2026-01-01"), 64)
    assert split["dbtable"] == "(SELECT 1) AS prices" and "query" not in split
    assert (split["partitionColumn"], split["numPartitions"]) == ("trade_date", "64")
    with pytest.raises(ValueError, match="bounds"):
        jdbc_options("jdbc:x", "SELECT 1", "trade_date")


def test_csv_stays_text_and_parquet_keeps_types(spark, tmp_path):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 2), 1.5)], PANEL)
    df.write.option("header", True).csv(str(tmp_path / "c"))
    df.write.parquet(str(tmp_path / "p"))
    csv = read_prices(spark, csv=str(tmp_path / "c"))
    assert [t for _, t in csv.dtypes] == ["string"] * 4 and tuple(csv.first()) == ("A", "2024-01-02", "1.5", None)
    assert read_prices(spark, parquet=str(tmp_path / "p")).dtypes == df.dtypes


def test_consensus_keeps_trading_days_and_fans_out(spark):
    fact = spark.createDataFrame([(1, 20240102, 10.0), (2, 20240102, 10.1), (1, 20240106, 11.0), (9, 20240102, 5.0)], "security_key int, date_key int, adj_close double")
    security = spark.createDataFrame([(1, "A"), (2, "A")], "security_key int, ticker string")
    dates = spark.createDataFrame(
        [(20240102, dt.date(2024, 1, 2), True), (20240106, dt.date(2024, 1, 6), False)],
        "date_key int, date date, is_trading_day boolean",
    )
    found = sorted(tuple(r) for r in consensus_prices(fact, security, dates).collect())
    assert found == [("A", dt.date(2024, 1, 2), 10.0), ("A", dt.date(2024, 1, 2), 10.1)]


def _trades(spark, rows):
    schema = "l_suppkey bigint, l_shipdate timestamp_ntz, l_extendedprice double, l_quantity double"
    return spark.createDataFrame([(k, dt.datetime(*day), px, q) for k, day, px, q in rows], schema)


def test_dense_panel_fills_weekdays(spark):
    trades = _trades(
        spark,
        [(1, (2024, 1, 3), 100.0, 10.0), (1, (2024, 1, 3), 50.0, 5.0), (1, (2024, 1, 8), 300.0, 10.0), (2, (2024, 1, 9), 8.0, 2.0), (1, (2024, 1, 6), 1.0, 1.0)],
    )
    found = {(r.ticker[-1], r.trade_date.day): r.adj_close for r in dense_panel(trades, rows=3).collect()}
    # supplier 1: Wed 3rd to Tue 9th without the weekend; the trailing window is three weekdays
    assert {d for t, d in found if t == "1"} == {3, 4, 5, 8, 9} and {d for t, d in found if t == "2"} == {9}
    assert found["1", 3] == 10.0 and found["1", 5] == 10.0 and found["1", 8] == 30.0 and found["2", 9] == 4.0


def test_dense_panel_has_gaps_where_nothing_traded_in_the_window(spark):
    trades = _trades(spark, [(1, (2024, 1, 1), 10.0, 1.0), (1, (2024, 1, 31), 20.0, 1.0)])
    days = [r.trade_date.day for r in dense_panel(trades, rows=3).orderBy("trade_date").collect()]
    assert days == [1, 2, 3, 31]


def test_sparse_panel_has_traded_days_only(spark):
    trades = _trades(spark, [(1, (2024, 1, 3), 100.0, 10.0), (1, (2024, 1, 8), 300.0, 10.0)])
    assert [(r.trade_date.day, r.adj_close) for r in sparse_panel(trades).orderBy("trade_date").collect()] == [(3, 10.0), (8, 30.0)]


def test_csv_keeps_damaged_lines(spark, tmp_path):
    folder = tmp_path / "quotes"
    folder.mkdir()
    (folder / "a.csv").write_text(
        'ticker,trade_date,adj_close,note\n"A, ""x""",2024-01-02,1,\nB,2024-01-02\nC,2024-01-03,2,n,extra\n'
        'D,"2024-01-02,3,n\nE,2024-01-04,5,"two words"\n'
    )
    (folder / "b.csv").write_text("ticker,trade_date,adj_close,note\nF,2024-01-05,6,\n")
    raw = read_prices(spark, csv=str(folder))
    bad = {r._bad_line for r in raw.filter("_bad_line IS NOT NULL").collect()}
    assert bad == {"B,2024-01-02", "C,2024-01-03,2,n,extra", 'D,"2024-01-02,3,n'}
    good = {(r.ticker, r.adj_close, r.note) for r in raw.filter("_bad_line IS NULL").collect()}
    assert good == {('A, "x"', "1", None), ("E", "5", "two words"), ("F", "6", None)}
    # a line is judged by all its fields, whatever is asked for
    assert raw.select("ticker").filter("ticker IS NULL").count() == 3
    with pytest.raises(contract.ContractError, match="ticker is null/unparseable in 3 rows"):
        contract.validate(raw)


def test_staged_rows_come_from_files(spark):
    frame, n = staging.stage_counted(spark.range(7), "seven")
    assert n == 7 and frame.count() == 7
    root = staging.staging_root(spark)
    run = staging.run_folder(spark)
    assert run.startswith(f"{root}/factorspark/")
    assert all(run.split("//")[-1] in path and "/seven-" in path for path in frame.inputFiles())


def test_a_bucketed_stage_is_read_without_a_shuffle(spark):
    with staging.scope(spark):
        rows = spark.range(100).select((F.col("id") % 9).alias("k"), "id")
        kept = staging.stage_bucketed(rows, "by_key", ["k"], 3)
        counted = kept.groupBy("k").count()
        assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
        assert counted.count() == 9 and any(t.name.startswith("staged_by_key") for t in spark.catalog.listTables())
    assert not any(t.name.startswith("staged_by_key") for t in spark.catalog.listTables())


def test_settings_come_back_and_frames_run_again_after_frugal(spark):
    keys = [staging._FREE_SHUFFLES, staging._ALL_JOIN_KEYS]
    before = [spark.conf.get(key) for key in keys]
    with pytest.raises(RuntimeError, match="stop"), staging.frugal(spark):
        with staging.frugal(spark):
            counted = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
            first = sorted(counted.collect())
        assert [spark.conf.get(key) for key in keys] == ["true", "false"]
        raise RuntimeError("stop")
    assert [spark.conf.get(key) for key in keys] == before
    assert sorted(counted.collect()) == first and len(first) == 7


def test_a_scope_leaves_nothing_behind(spark):
    with staging.scope(spark) as name:
        inside = staging.stage(spark.range(3), "three")
        assert inside.count() == 3 and all(f"/{name}/" in path for path in inside.inputFiles())
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{staging.run_folder(spark)}/{name}")
    assert not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    assert "/shared/" in staging.stage(spark.range(1), "one").inputFiles()[0]


def _stored(spark, folder):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_a_discarded_frame_leaves_no_files_and_others_stay(spark):
    one, other = staging.stage(spark.range(3), "one"), staging.stage(spark.range(4), "other")
    folder = one.inputFiles()[0].rsplit("/", 1)[0]
    staging.discard(one, spark.range(2), other.filter("id > 1"))
    assert not _stored(spark, folder) and other.count() == 4
    staging.discard(one)


def test_a_frame_staged_alone_leaves_only_itself(spark):
    between = []

    def plan():
        stored = staging.stage(spark.range(5), "between")
        between.append(stored.inputFiles()[0])
        return stored.filter("id > 2")

    found = staging.stage_alone(spark, plan, "alone")
    assert found.count() == 2 and "/shared/alone-" in found.inputFiles()[0]
    assert not _stored(spark, between[0])


class _Session:
    """Just the settings that decide where intermediate results go."""

    def __init__(self, master, setting=None, folder=None):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = self
        self.master = master
        self._folder = folder

    def getCheckpointDir(self):
        return self._folder


def test_staging_folder(tmp_path):
    assert staging.staging_root(_Session("yarn", setting="/shared/a")) == "/shared/a"
    assert staging.staging_root(_Session("yarn", folder="/shared/b")) == "/shared/b"
    for master in ("yarn", "local[8]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            staging.staging_root(_Session(master))


def test_load_replaces_and_verifies(spark, monkeypatch):
    tables = Tables(spark, "load_test")
    first = spark.createDataFrame([("A", dt.date(2024, 1, 2), 1.0), ("B", dt.date(2024, 1, 2), 2.0)], PANEL)
    assert tables.load_prices(first).count() == 2
    assert tables.load_prices(first.limit(1)).count() == 1
    assert tables.raw_prices.dtypes == first.dtypes
    counted = Tables._verify
    monkeypatch.setattr(Tables, "_verify", staticmethod(lambda name, sent, loaded: counted(name, sent, loaded - 1)))
    with pytest.raises(LoadError, match="sent 2 rows, loaded 1"):
        tables.load_prices(first)
    # the old table is still there, and nothing beside it
    assert tables.raw_prices.count() == 1
    assert [t.name for t in spark.catalog.listTables("load_test")] == ["raw_prices"]


def test_a_failed_write_leaves_the_old_table(spark):
    tables = Tables(spark, "swap_test")
    tables.ensure_schema()
    month = F.date_add(F.lit(dt.date(2024, 1, 31)), (F.col("id") % 3).cast("int")).alias("m")
    tables.materialize(spark.range(9).select("id", month), "months", partition_by="m")
    for _ in range(2):  # a replacement may read the table that it replaces
        tables.materialize(tables.months.withColumn("id", F.col("id") + 1), "months", partition_by="m")
    broken = tables.months.withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        tables.materialize(broken, "months", partition_by="m")
    assert sorted(r.id for r in tables.months.collect()) == list(range(2, 11))
    assert [t.name for t in spark.catalog.listTables("swap_test")] == ["months"]


def test_a_swap_that_was_cut_short_is_mended(spark):
    tables = Tables(spark, "mend_test")
    tables.ensure_schema()
    tables.materialize(spark.range(5), "five")
    spark.sql("ALTER TABLE mend_test.five RENAME TO mend_test.five__old")  # where a process died
    with pytest.raises(Exception, match="lost"):
        tables.materialize(spark.range(1).select(F.raise_error(F.lit("lost")).alias("id")), "five")
    assert tables.five.count() == 5


def test_partitions_are_replaced_alone(spark):
    tables = Tables(spark, "part_test")
    tables.ensure_schema()
    days = [dt.date(2024, m, 28) for m in (1, 2, 3, 4)]
    rows = [(f"K{i}", float(i), day) for day in days for i in range(5)]
    tables.materialize(spark.createDataFrame(rows, "k string, x double, d date"), "t", partition_by="d")
    files = {d: set(tables.t.filter(F.col("d") == F.lit(d)).inputFiles()) for d in days}
    fresh = spark.createDataFrame([("N", days[1], 7.0)], "k string, d date, x double")  # another column order
    tables.replace_partitions(fresh, "t", [days[1], days[2]])
    left = {d: [(r.k, r.x) for r in tables.t.filter(F.col("d") == F.lit(d)).collect()] for d in days}
    assert left[days[1]] == [("N", 7.0)] and left[days[2]] == [] and len(left[days[0]]) == len(left[days[3]]) == 5
    for d in (days[0], days[3]):
        assert set(tables.t.filter(F.col("d") == F.lit(d)).inputFiles()) == files[d]


def test_ad_hoc_sql_has_lower_case_names(spark):
    tables = Tables(spark, "query_test")
    tables.load_prices(spark.createDataFrame([("A", dt.date(2024, 1, 2), 1.0)], PANEL))
    tables.register_views(["raw_prices"])
    result = tables.query("SELECT TICKER AS T, ADJ_CLOSE * 2 AS Twice FROM raw_prices")
    assert result.columns == ["t", "twice"] and tuple(result.first()) == ("A", 2.0)


def test_bucketed_table_is_read_without_a_shuffle(spark):
    from factorspark.params import Params
    from factorspark.plans.returns import daily_returns

    tables = Tables(spark, "bucket_test")
    rows = [(f"T{i % 7}", dt.date(2024, 1, 1) + dt.timedelta(days=i), 1.0 + i) for i in range(70)]
    tables.load_prices(spark.createDataFrame(rows, PANEL))
    plan = daily_returns(tables.raw_prices, Params())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert tables.raw_prices.select(F.input_file_name()).distinct().count() <= 8


def test_panels_with_a_hot_supplier(spark):
    """A third of all trades belongs to one supplier; both panels against plain loops."""
    rng = random.Random(9)
    start = dt.date(2024, 1, 1)
    rows = []
    for i in range(1500):
        day = start + dt.timedelta(days=rng.randrange(90))
        key = 7 if i % 3 == 0 else rng.randrange(20, 60)
        rows.append((key, (day.year, day.month, day.day), rng.randrange(100, 90000) / 100, float(rng.randint(1, 50))))
    trades = _trades(spark, rows).repartition(6)

    totals = {}
    for key, day, price, units in rows:
        if dt.date(*day).weekday() < 5:
            cents, n = totals.get((key, dt.date(*day)), (0, 0))
            totals[key, dt.date(*day)] = (cents + round(price * 100), n + int(units))
    sparse = {(k, d): c / n / 100.0 for (k, d), (c, n) in totals.items()}
    assert {(int(r.ticker[1:]), r.trade_date): r.adj_close for r in sparse_panel(trades).collect()} == sparse

    last = max(dt.date(*day) for _, day, _, _ in rows)
    weekdays = [d for d in (start + dt.timedelta(days=k) for k in range(90)) if d.weekday() < 5 and d <= last]
    dense = {}
    for key in {k for k, _ in totals}:
        series = [totals.get((key, d), (0, 0)) for d in weekdays]
        for t, day in enumerate(weekdays):
            cents, n = (sum(x) for x in zip(*series[max(0, t - 9) : t + 1]))
            if n:
                dense[key, day] = cents / n / 100.0
    found = {(int(r.ticker[1:]), r.trade_date): r.adj_close for r in dense_panel(trades, rows=10).collect()}
    assert found == dense


def test_the_tasks_of_a_dense_panel_follow_its_rows(spark, monkeypatch):
    """40 tickers fill in 20 to 59 weeks each from two trades; a NULL key and a weekend count for none."""
    schema = "l_suppkey long, l_shipdate date, l_extendedprice double, l_quantity double"
    last = dt.date(2024, 7, 12)  # a Friday
    rows = [(k, last - dt.timedelta(weeks=20 + k), 10.0 + k, 1.0) for k in range(40)]
    rows += [(k, last, 20.0, 2.0) for k in range(40)]
    rows += [(None, dt.date(1990, 1, 1), 1.0, 1.0), (99, dt.date(1990, 1, 6), 1.0, 1.0)]
    trades = spark.createDataFrame(rows, schema)
    filled = sum((last - day).days + 1 for k, day, *_ in rows[:40])
    assert dense_rows(trades) == -(-filled * 5 // 7)
    assert dense_rows(trades.limit(0)) == 0
    plain = {tuple(r) for r in dense_panel(trades).collect()}

    monkeypatch.setattr(staging, "TASK_ROWS", 300)
    found = dense_panel(trades)
    held = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == len(plain) and {tuple(r) for r in found.collect()} == plain
    assert f"hashpartitioning(ticker, {-(-dense_rows(trades) // 300)})" in _numberless(found)
    # the caller's number wins
    assert "hashpartitioning(ticker, 11)" in _numberless(dense_panel(trades, size=3300))


def _numberless(df):
    """The plan without the numbers of its expressions."""
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())
