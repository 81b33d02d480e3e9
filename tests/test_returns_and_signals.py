import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panels import PANEL, business_days, swinging_panel
from factorspark.params import Params
from factorspark.plans import returns as R
from factorspark.plans import signals as S


def _returns(spark, rows, params):
    return R.daily_returns(spark.createDataFrame(rows, PANEL), params)


def _signals(spark, rows, params):
    returns = _returns(spark, rows, params)
    return S.signals(returns, R.market_proxy(returns, params))


def _series(df, ticker, *columns):
    rows = df.filter(F.col("ticker") == ticker).orderBy("trade_date").select(*columns).collect()
    return [row[0] if len(columns) == 1 else tuple(row) for row in rows]


def test_return_is_null_across_a_gap_only(spark, params):
    rows = swinging_panel([0.7, 1.1, 1.3], n_days=33)
    kept = rows[:33] + [r for k, r in enumerate(rows[33:66]) if not 12 <= k < 19] + rows[66:]
    ret = _series(_returns(spark, kept, params), "ABX", "ret_1d")
    assert len(ret) == 26
    assert [i for i, r in enumerate(ret) if r is None] == [0, 12]  # seven weekdays are missing before row 12


def test_gap_limit_is_inclusive(spark, params):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 6), dt.date(2024, 1, 12)]
    rows = [("A", day, 100.0 + i) for i, day in enumerate(days)]
    ret = _series(_returns(spark, rows, params), "A", "ret_1d")
    assert ret[1] == pytest.approx(0.01) and ret[2] is None


def test_bad_price_is_skipped_before_the_lag(spark, params):
    days = business_days("2024-01-01", 4)
    rows = list(zip("AAAA", days, [100.0, 0.0, -5.0, 110.0]))
    returns = _returns(spark, rows, params)
    assert _series(returns, "A", "adj_close") == [100.0, 110.0]
    assert _series(returns, "A", "ret_1d")[1] == pytest.approx(0.10)


def test_market_needs_enough_names(spark, params):
    day1, day2, day3 = business_days("2024-01-01", 3)
    rows = [(f"N{i}", day, 100.0 + i + k) for i in range(5) for k, day in enumerate((day1, day2))]
    rows += [(f"N{i}", day3, 120.0) for i in range(4)]
    market = R.market_proxy(_returns(spark, rows, params), params).collect()
    assert [(m.trade_date, m.n_names) for m in market] == [(day2, 5)]
    expected = sum(1 / (100.0 + i) for i in range(5)) / 5
    assert market[0].mkt_ret == pytest.approx(expected, abs=1e-15)


def test_latest_month_is_never_a_rebalance_month(spark, params):
    rows = swinging_panel([0.5, 1.5, 1.0, 0.7, 1.2], n_days=130, wobble=0.01)
    market = R.market_proxy(_returns(spark, rows, params), params)
    last = market.agg(F.max("trade_date")).first()[0]
    calendar = R.rebalance_dates(market).collect()
    assert max(c.month_idx for c in calendar) == last.year * 12 + last.month - 1
    traded = {r[1] for r in rows}
    for c in calendar:
        later = [d for d in traded if (d.year, d.month) == (c.rebalance_date.year, c.rebalance_date.month)]
        assert c.rebalance_date == max(later) and c.month_idx == c.rebalance_date.year * 12 + c.rebalance_date.month


def test_beta_is_the_slope_over_the_mean_slope(spark, params):
    slopes = [0.2, 0.9, 1.0, 2.3, 1.6, 0.4, 0.9]
    signals = _signals(spark, swinging_panel(slopes, n_days=320), params)
    for i, slope in enumerate(slopes):
        beta = _series(signals, f"A{chr(65 + i)}X", "beta_252d")
        # 252 pairs need 253 prices
        assert beta[251] is None and beta[252] is not None
        assert beta[-1] == pytest.approx(slope * len(slopes) / sum(slopes), rel=1e-6)


def test_volatility_of_a_known_sequence(spark, params):
    # returns alternate between +2% and -1%: the deviation of any 63 of them is known
    days = business_days("2020-06-01", 90)
    rows = []
    for name in ("UP", "UQ", "UR", "US", "UT"):
        price = 64.0
        for k, day in enumerate(days):
            price *= 1 if k == 0 else 1.02 if k % 2 else 0.99
            rows.append((name, day, price))
    vol = _series(_signals(spark, rows, params), "UR", "vol_63d")
    assert vol.index(next(v for v in vol if v is not None)) == 63  # 63 returns need 64 prices
    ones, rest = 32, 31
    spread = math.sqrt(0.03**2 * ones * rest / 63 / 62 * 252)
    assert vol[63:] == pytest.approx([spread] * 27, rel=1e-9)
    steady = [(name, day, 5.0 * 1.002**k) for name in "VWXYZ" for k, day in enumerate(days)]
    assert max(v for v in _series(_signals(spark, steady, params), "W", "vol_63d") if v is not None) < 1e-5


def test_momentum_and_reversal_follow_the_lags(spark, params):
    rows = swinging_panel([0.6, 1.0, 1.4, 0.8, 1.2], n_days=290, wobble=0.003)
    price = [r[2] for r in rows if r[0] == "AEX"]
    found = _series(_signals(spark, rows, params), "AEX", "mom_12_1", "rev_21d")
    month = {t: price[t] / price[t - 21] - 1 for t in range(21, 290)}
    year = {t: price[t - 21] / price[t - 252] - 1 for t in range(252, 290)}
    assert {t for t, row in enumerate(found) if row[1] is not None} == set(month)
    assert {t for t, row in enumerate(found) if row[0] is not None} == set(year)
    assert [found[t][1] for t in month] == pytest.approx(list(month.values()), abs=1e-11)
    assert [found[t][0] for t in year] == pytest.approx(list(year.values()), abs=1e-11)


def test_span_gates_reject_calendar_day_panels(spark, params):
    # 21 rows span only 21 days when weekends trade
    start = dt.date(2022, 1, 1)
    rows = [(f"D{i}", start + dt.timedelta(days=k), 100.0 + k % 7 + i) for i in range(6) for k in range(300)]
    signals = _signals(spark, rows, params)
    assert signals.filter("mom_12_1 IS NOT NULL OR rev_21d IS NOT NULL").isEmpty()
    assert not signals.filter("vol_63d IS NOT NULL").isEmpty()


def test_beta_needs_every_pair_and_a_moving_market(spark, params):
    rows = swinging_panel([1.0] * 5, n_days=300, wobble=0.01)
    missing = [r for r in rows if not (r[0] == "AAX" and r[1] == rows[150][1])]
    beta = _series(_signals(spark, missing, params), "AAX", "beta_252d")
    assert beta[-1] is not None  # the gap is short: the return across it is valid
    flat = [(f"F{i}", day, 100.0) for i in range(6) for day in business_days("2022-01-03", 280)]
    assert _signals(spark, flat, params).filter("beta_252d IS NOT NULL").isEmpty()


def test_window_sums_match_sliding_frames(spark, params):
    """The additive sums against plain frames, on a panel with gaps and an extreme price."""
    rows = swinging_panel([0.6, 0.8, 1.0, 1.2, 1.4, 1.6], n_days=420, wobble=0.01)
    rows = [r for k, r in enumerate(rows) if k % 97 != 5]
    rows[50] = (rows[50][0], rows[50][1], rows[50][2] * 1e6)
    returns = _returns(spark, rows, params)
    market = R.market_proxy(returns, params)
    over = "OVER (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
    v, b = over.format(62), over.format(251)
    plain = R.returns_vs_market(returns, market).selectExpr(
        "ticker",
        "trade_date",
        f"CASE WHEN count(ret_1d) {v} = 63 THEN stddev_samp(ret_1d) {v} * sqrt(252D) END AS vol",
        f"CASE WHEN count(ret_b) {b} = 252 THEN covar_pop(ret_b, mkt_b) {b} / var_pop(mkt_b) {b} END AS beta",
    )
    both = S.signals(returns, market).join(plain, ["ticker", "trade_date"])
    assert both.filter("(vol IS NULL) <> (vol_63d IS NULL) OR (beta IS NULL) <> (beta_252d IS NULL)").isEmpty()
    worst = both.agg(
        F.max(F.abs(F.col("vol") - F.col("vol_63d")) / F.greatest("vol", F.lit(1.0))),
        F.max(F.abs(F.col("beta") - F.col("beta_252d")) / F.greatest(F.abs("beta"), F.lit(1.0))),
        F.count("beta"),
    ).first()
    assert worst[0] < 1e-9 and worst[1] < 1e-9 and worst[2] > 0


def test_signals_shuffle_daily_rows_once(spark, params, tmp_path):
    prices = spark.createDataFrame(swinging_panel([1.0] * 6, n_days=30), PANEL)
    _returns(spark, swinging_panel([1.0] * 6, n_days=30), params).write.parquet(str(tmp_path / "r"))
    returns = spark.read.parquet(str(tmp_path / "r"))
    plan = S.signals(returns, R.market_proxy(returns, params))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(ticker") == 1
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
    assert prices.count() == 180


def test_volatility_is_annualised(spark, params):
    rows = swinging_panel([1.0] * 6, n_days=80, wobble=0.01)
    px = [r[2] for r in rows if r[0] == "ACX"]
    daily = [b / a - 1 for a, b in zip(px, px[1:])][-63:]
    mean = sum(daily) / 63
    expected = math.sqrt(sum((r - mean) ** 2 for r in daily) / 62 * 252)
    assert _series(_signals(spark, rows, params), "ACX", "vol_63d")[-1] == pytest.approx(expected, rel=1e-12)
    assert Params().min_universe == 30 and Params().max_gap_days == 5
