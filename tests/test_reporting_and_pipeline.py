import csv
import datetime as dt
import glob
import math
import time
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panels import PANEL, swinging_panel
from factorspark.params import Params
from factorspark.plans import checks, dims, parity, pipeline, reporting
from factorspark.plans.contract import ContractError
from factorspark.plans.run import FactorRun
from factorspark.sources import staging
from factorspark.sources.catalog import Tables

SUMMARY = "factor string, n_months bigint, ann_ls_return double, ann_ls_vol double, ls_sharpe double, hit_rate double, mean_ic double, icir double"
SERIES = "rebalance_date date, factor string, {} double"


def _summary(spark):
    rows = [
        ("mom_12_1", 80, 0.04, 0.17, 0.2547, 0.53, 0.01, 0.07),
        ("vol_63d", 89, -0.21, 0.22, -0.9474, 0.37, -0.04, -0.14),
        ("rev_21d", 91, 0.01, 0.15, 0.07, 0.50, 0.03, 0.25),
        ("zzz", 10, 0.0, 0.0, None, 0.0, 0.0, 0.1),
    ]
    return spark.createDataFrame(rows, SUMMARY)


def _months(n, start=(2023, 1)):
    first = start[0] * 12 + start[1] - 1
    return [dt.date(m // 12, m % 12 + 1, 28) for m in range(first, first + n)]


def _series(spark, values, column, factor="f"):
    rows = [(d, factor, v) for d, v in zip(_months(len(values)), values)]
    return spark.createDataFrame(rows, SERIES.format(column))


def test_t_statistics_and_verdicts(spark):
    found = {r.factor: r for r in reporting.factor_significance(_summary(spark)).collect()}
    assert round(found["vol_63d"].t_ls, 2) == -2.58 and round(found["rev_21d"].t_ic, 2) == 2.38
    assert {f: r.verdict for f, r in found.items()} == {"mom_12_1": "flat", "vol_63d": "spread", "rev_21d": "ic_only", "zzz": None}


def test_results_table_is_in_display_order(spark):
    rows = reporting.results_table(_summary(spark), dims.dim_factor(spark)).orderBy("position").collect()
    assert [r.label for r in rows] == ["Momentum (12-1)", "Short-term reversal (1M)", "Low volatility (63d)", "zzz"]
    assert rows[2].ann_ls_return_pct == pytest.approx(-21.0) and rows[2].months == 89


def test_unknown_factors_come_last_by_name(spark):
    names = spark.createDataFrame([(f,) for f in ("b", "beta_252d", "a", "mom_12_1")], "factor string")
    ordered = [r.factor for r in reporting.factor_order(names).orderBy("position").collect()]
    assert ordered == ["mom_12_1", "beta_252d", "a", "b"]


def test_rolling_mean_needs_twelve_months(spark):
    values = [float(i) for i in range(14)]
    rows = reporting.ic_rolling(_series(spark, values, "ic")).orderBy("rebalance_date").collect()
    assert [r.ic_mean_12m for r in rows] == [None] * 11 + [5.5, 6.5, 7.5]


def test_cumulative_spread_skips_a_missing_month(spark):
    rows = reporting.cumulative_spread(_series(spark, [0.1, None, -0.5], "ls_ret")).orderBy("rebalance_date").collect()
    assert rows[0].cum_spread == pytest.approx(0.1) and rows[1].cum_spread is None
    assert rows[2].cum_spread == pytest.approx(1.1 * 0.5 - 1)


def test_cumulative_spread_on_the_month_spine(spark):
    days = _months(3)
    returns = _series(spark, [0.1, 0.2], "ls_ret", "mom_12_1").unionByName(_series(spark, [0.3], "ls_ret", "rev_21d"))
    months = spark.createDataFrame([(d,) for d in days], "month_end date")

    def found(**options):
        spine = reporting.cumulative_spread_spine(returns, months, dims.dim_factor(spark), **options)
        return {(r.factor, r.month_end): r.cum_spread for r in spine.collect()}

    one = found(factors=["mom_12_1", "rev_21d"])
    assert len(one) == 6
    assert one["mom_12_1", days[2]] == pytest.approx(1.1 * 1.2 - 1)  # no data in month three: neutral
    assert one["rev_21d", days[2]] == pytest.approx(0.3)
    mean = found(per_factor=False)
    known = found()
    assert {f for f, _ in known} == {"mom_12_1", "rev_21d", "vol_63d", "beta_252d"}
    returns = returns.unionByName(_series(spark, [0.5], "ls_ret", "quality"))
    assert found()["quality", days[2]] == pytest.approx(0.5)  # a factor the dimension does not know
    assert mean["all", days[0]] == pytest.approx(0.2) and mean["all", days[1]] == pytest.approx(1.2 * 1.2 - 1)


def test_ic_t_statistic(spark):
    values = [0.1, 0.2, 0.4]
    row = reporting.ic_tstats(_series(spark, values, "ic")).first()
    assert row.t_ic == pytest.approx(np.mean(values) / np.std(values, ddof=1) * math.sqrt(3))
    assert reporting.ic_tstats(_series(spark, [0.1, 0.1], "ic")).first().t_ic is None


def test_measures_follow_their_filters(spark, noisy_run):
    fr, ic = noisy_run.mart_factor_returns, noisy_run.mart_ic
    summary = {r.factor: r for r in noisy_run.mart_factor_summary.collect()}
    one = reporting.factor_measures(fr, ic, factors=["rev_21d"]).first()
    for c in ("ann_ls_return", "ann_ls_vol", "ls_sharpe", "hit_rate", "mean_ic", "icir"):
        assert one[c] == pytest.approx(summary["rev_21d"][c], rel=1e-12)
    cut = fr.agg(F.max("rebalance_date")).first()[0]
    last = reporting.factor_measures(fr, ic, start=str(cut), end=str(cut)).first()
    expected = fr.filter(F.col("rebalance_date") == F.lit(cut)).agg(F.avg("ls_ret")).first()[0]
    assert last.ls_return_month == pytest.approx(expected)
    differences = reporting.reconciliation(fr, ic, noisy_run.mart_factor_summary)
    assert differences.count() == 24 and differences.filter("abs(diff) > 1e-12 OR diff IS NULL").isEmpty()


def test_quintile_profile(spark, noisy_run):
    profile = reporting.quintile_profile(noisy_run.mart_factor_returns)
    expected = noisy_run.mart_factor_returns.filter("factor = 'vol_63d'").agg(F.avg("q4_ret")).first()[0]
    assert profile.count() == 20
    assert profile.filter("factor = 'vol_63d' AND quintile = 4").first().mean_ret == pytest.approx(expected)


def test_star_has_no_orphans(spark, noisy_run):
    facts = {"mart_ic": noisy_run.mart_ic, "mart_scores_monthly": noisy_run.mart_scores_monthly}
    rows = reporting.star_orphans(facts, noisy_run.dim_factor, noisy_run.dim_month).collect()
    assert all(r.missing_factor == r.missing_month == 0 for r in rows) and len(rows) == 2
    fewer = noisy_run.dim_month.filter("mth <> 6")
    assert reporting.star_orphans(facts, noisy_run.dim_factor, fewer).filter("missing_month = 0").isEmpty()
    star = reporting.star_view(noisy_run.mart_ic, noisy_run.dim_factor, noisy_run.dim_month)
    assert star.count() == noisy_run.mart_ic.count() and {"label", "direction", "yr", "mth"} <= set(star.columns)


def test_export(noisy_run, tmp_path):
    written = reporting.export_marts(noisy_run, str(tmp_path))
    assert [w.rsplit("/", 1)[1] for w in written] == [*reporting.EXPORTS, "manifest"]

    def rows(name):
        (path,) = glob.glob(f"{tmp_path}/{name}/*.csv")
        with open(path, encoding="utf-8") as file:
            return list(csv.DictReader(file))

    summary = rows("mart_factor_summary")
    assert [r["factor"] for r in summary] == ["beta_252d", "mom_12_1", "rev_21d", "vol_63d"]
    exact = {r.factor: r.ann_ls_vol for r in noisy_run.mart_factor_summary.collect()}
    for r in summary:
        assert float(r["ann_ls_vol"]) == float(f"{exact[r['factor']]:.10g}")
    returns = rows("mart_factor_returns")
    assert len(returns) == noisy_run.mart_factor_returns.count()
    assert returns == sorted(returns, key=lambda r: (r["factor"], r["rebalance_date"]))
    manifest = {r["item"]: r["value"] for r in rows("manifest")}
    assert manifest["raw_rows"] == "18000" and manifest["raw_tickers"] == "20" and manifest["rows_dim_factor"] == "4"
    assert manifest["scored_months"] == str(noisy_run.mart_ic.select("rebalance_date").distinct().count())


def test_export_keeps_missing_values(spark):
    frame = spark.createDataFrame([("a", None), ("b", float("nan")), ("c", float("inf")), ("d", 1 / 3)], "factor string, x double")
    found = [r.x for r in reporting.export_table(frame, ["factor"]).collect()]
    assert found[0] is None and math.isnan(found[1]) and found[2] == math.inf and found[3] == 0.3333333333


def test_results_table_reads_the_summary_once(spark, tmp_path):
    _summary(spark).write.parquet(str(tmp_path / "s"))
    table = reporting.results_table(spark.read.parquet(str(tmp_path / "s")), dims.dim_factor(spark))
    assert table._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_dimension(spark):
    rows = dims.dim_factor(spark).collect()
    assert [(r.factor, r.direction) for r in rows] == [("mom_12_1", 1), ("rev_21d", -1), ("vol_63d", -1), ("beta_252d", -1)]


# --- build --------------------------------------------------------------------------------------


def test_build_in_the_catalog_equals_the_lazy_run(spark, noisy_run):
    params = Params(schema="built", min_universe=5, daily_buckets=5)
    prices = spark.createDataFrame(swinging_panel(np.linspace(0.3, 1.5, 20), 900, 0.006), PANEL)
    report = pipeline.run(spark, prices, params)
    assert report.failures == [] and report.deduped_groups == 0
    assert (report.profile.n_rows, report.profile.n_tickers) == (18000, 20)
    assert report.window.n_months == noisy_run.dim_month.count()
    built = Tables(spark, "built")
    assert parity.has_parity(parity.parity(built, noisy_run))
    for table in parity.TABLES:
        assert dict(getattr(built, table).dtypes) == dict(getattr(noisy_run, table).dtypes), table

    # a subset of the stages reads what is stored
    spark.sql("DROP TABLE built.mart_ic")
    assert pipeline.build(spark, params, ["marts"]) == ["marts"]
    assert built.mart_ic.count() == noisy_run.mart_ic.count()
    with pytest.raises(ValueError, match="unknown stages"):
        pipeline.build(spark, params, ["mart"])
    # checks on stored tables alone
    assert checks.messages(checks.run_checks(built))[0] == []

    # signals and forward returns read the bucketed returns without another shuffle, also with
    # another number of shuffle partitions than buckets
    from factorspark.plans import scores, signals

    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED built.returns").collect()}
    assert described["Num Buckets"] == str(params.daily_buckets) != spark.conf.get("spark.sql.shuffle.partitions")
    daily = signals.signals(built.returns, built.market, by_ticker=True)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(ticker" not in plan
    plan = scores.forward_returns(built.returns, built.rebalance_dates)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(ticker" not in plan


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {path for folder in manager.localDirsString() for path in Path(folder).rglob("shuffle_*.data")}


def test_a_run_keeps_only_its_tables_on_disk(spark, monkeypatch):
    """The panel goes before the build, shuffle files with the query that wrote them; daily prices lie by
    ticker and day."""
    staged, begun, build = [], {}, pipeline.build

    def after_loading(session, params):
        root = Path(urlparse(staging.run_folder(session)).path)
        begun["panels"] = [path for path in root.rglob("panel-*") if path not in staged]
        return build(session, params)

    monkeypatch.setattr(pipeline, "build", after_loading)
    staged += Path(urlparse(staging.run_folder(spark)).path).rglob("panel-*")
    before = _shuffle_files(spark)
    prices = spark.createDataFrame(swinging_panel(np.linspace(0.3, 1.5, 20), 900, 0.006), PANEL)
    pipeline.run(spark, prices, Params(schema="lean", min_universe=5, daily_buckets=3))
    assert begun["panels"] == []
    until = time.monotonic() + 10  # files are removed in the background
    while _shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before

    for name in ("raw_prices", "returns", "signals"):
        for path in spark.table(f"lean.{name}").inputFiles():
            file = pq.ParquetFile(urlparse(path).path)
            group = file.metadata.row_group(0)
            chunks = [group.column(i) for i in range(group.num_columns)]
            assert {chunk.compression for chunk in chunks} == {"ZSTD"}
            assert not any(chunk.has_dictionary_page for chunk in chunks if chunk.physical_type == "DOUBLE")
            rows = [(r["ticker"], r["trade_date"]) for r in file.read(["ticker", "trade_date"]).to_pylist()]
            assert rows == sorted(rows) and len(rows) >= 900


def test_a_broken_panel_is_not_loaded(spark):
    prices = spark.createDataFrame([("A", dt.date(2024, 1, 2), -1.0)], PANEL)
    with pytest.raises(ContractError):
        pipeline.run(spark, prices, Params(schema="never"))
    assert not spark.catalog.databaseExists("never")


def test_months_are_rebuilt_alone(spark, noisy_run):
    params = Params(schema="months", min_universe=5, daily_buckets=3)
    prices = spark.createDataFrame(swinging_panel(np.linspace(0.3, 1.5, 20), 900, 0.006), PANEL)
    pipeline.run(spark, prices, params)
    built = Tables(spark, "months")
    months = [r.month_end for r in built.dim_month.orderBy("month_end").collect()]
    wrong, lost, *kept = months[3:]

    def files(day):
        return set(built.mart_scores_monthly.filter(F.col("rebalance_date") == F.lit(day)).inputFiles())

    before = {day: files(day) for day in kept}
    worse = built.mart_scores_monthly.filter(F.col("rebalance_date") == F.lit(wrong)).withColumn("score", F.lit(9.0))
    rows = worse.collect()
    worse = spark.createDataFrame(rows, built.mart_scores_monthly.schema)
    built.replace_partitions(worse, "mart_scores_monthly", [wrong, lost])
    assert not parity.has_parity(parity.parity(built, noisy_run))
    pipeline.rebuild_months(spark, params, [wrong, lost])
    assert parity.has_parity(parity.parity(built, noisy_run))
    assert {day: files(day) for day in kept} == before
    # one month reads one folder
    plan = built.month_end.filter(F.col("rebalance_date") == F.lit(lost))
    assert len({path.rsplit("/", 2)[1] for path in plan.inputFiles()}) == 1


def test_scores_and_forward_returns_join_without_a_shuffle(spark, noisy_run):
    from factorspark.plans import marts

    params = Params(schema="joined", min_universe=5, daily_buckets=3)
    prices = spark.createDataFrame(swinging_panel(np.linspace(0.3, 1.5, 20), 900, 0.006), PANEL)
    pipeline.run(spark, prices, params)
    built = Tables(spark, "joined")
    joined = marts.scores_with_forward(built.scores, built.fwd_returns)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    plain = noisy_run.scores.join(noisy_run.fwd_returns, ["ticker", "rebalance_date"], "left")
    keys = ["ticker", "rebalance_date", "factor", "raw_value", "fwd_ret_1m"]
    assert joined.select(keys).exceptAll(plain.select(keys)).isEmpty() and plain.count() == joined.count()


def test_lazy_signals_read_the_returns_without_a_shuffle(noisy_run):
    plan = noisy_run.signals._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(ticker" not in plan


def _num_buckets(spark, table):
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return int(described["Num Buckets"])


def test_the_buckets_of_a_build_follow_its_rows(spark, noisy_run, monkeypatch):
    """18,000 daily rows; the named number of buckets would hold 6,000 rows each."""
    monkeypatch.setattr(staging, "TASK_ROWS", 1000)
    params = Params(schema="sized", min_universe=5, daily_buckets=3)
    prices = spark.createDataFrame(swinging_panel(np.linspace(0.3, 1.5, 20), 900, 0.006), PANEL)
    pipeline.run(spark, prices, params)
    built = Tables(spark, "sized")
    for name in ("raw_prices", "returns", "signals"):
        assert _num_buckets(spark, f"sized.{name}") == 18, name
    joined = {_num_buckets(spark, f"sized.{name}") for name in ("scores", "fwd_returns")}
    assert joined == {max(3, -(-built.month_end.count() * 4 // 1000))}
    assert parity.has_parity(parity.parity(built, noisy_run))


@pytest.mark.parametrize("rows", [None, 18_000])
def test_the_buckets_of_a_lazy_run_follow_its_rows(spark, noisy_run, monkeypatch, rows):
    monkeypatch.setattr(staging, "TASK_ROWS", 1000)
    prices = spark.createDataFrame(swinging_panel(np.linspace(0.3, 1.5, 20), 900, 0.006), PANEL)
    run = FactorRun(prices, Params(min_universe=5, daily_buckets=3), rows)
    assert run.returns.count() == 18_000
    table = staging._tables["shared"][-1]
    assert _num_buckets(spark, table) == 18
    assert parity.has_parity(parity.parity(run, noisy_run))
