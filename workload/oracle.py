"""DuckDB statements that must give the rows of the queries.

They are written independently of the Spark plans: statistical window aggregates instead of
additive sums, self joins instead of lead, joins instead of stacking.
"""

from __future__ import annotations

# Each entry is one common table expression; a statement is prefixed with all of them up to the
# last one it needs (unused ones cost nothing).

_DENSE = {
    "trades": """
        SELECT 'S' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') AS ticker, CAST(l_shipdate AS DATE) AS day,
               sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents, sum(CAST(l_quantity AS BIGINT)) AS units
        FROM lineitem
        WHERE l_suppkey IS NOT NULL AND isodow(CAST(l_shipdate AS DATE)) <= 5
        GROUP BY ALL""",
    "spine": """
        SELECT ticker, CAST(unnest(generate_series(min(day), (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem),
                                                   INTERVAL 1 DAY)) AS DATE) AS day
        FROM trades GROUP BY ticker""",
    "summed": """
        SELECT s.ticker, s.day, sum(t.cents) OVER w AS cents, sum(t.units) OVER w AS units
        FROM spine s LEFT JOIN trades t ON t.ticker = s.ticker AND t.day = s.day
        WHERE isodow(s.day) <= 5
        WINDOW w AS (PARTITION BY s.ticker ORDER BY s.day ROWS BETWEEN 62 PRECEDING AND CURRENT ROW)""",
    "raw_prices": """
        SELECT ticker, day AS trade_date, CAST(cents AS DOUBLE) / CAST(units AS DOUBLE) / 100 AS adj_close
        FROM summed WHERE units > 0""",
}

_SPARSE = {
    "trades": _DENSE["trades"],
    "raw_prices": """
        SELECT ticker, day AS trade_date, CAST(cents AS DOUBLE) / CAST(units AS DOUBLE) / 100 AS adj_close
        FROM trades WHERE units > 0""",
}

_GAPPY = {**_DENSE, "summed": _DENSE["summed"].replace("62 PRECEDING", "9 PRECEDING")}

_MODEL = {
    "returns": """
        SELECT ticker, trade_date, adj_close,
               CASE WHEN trade_date - lag(trade_date) OVER w <= 5 THEN adj_close / lag(adj_close) OVER w - 1 END AS ret_1d
        FROM raw_prices WHERE adj_close > 0
        WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)""",
    "market": """
        SELECT trade_date, avg(ret_1d) AS mkt_ret, count(ret_1d) AS n_names
        FROM returns GROUP BY trade_date HAVING count(ret_1d) >= 5""",
    "months": """
        SELECT date_trunc('month', trade_date) AS mon, max(trade_date) AS rebalance_date FROM market GROUP BY 1""",
    "rebalance_dates": """
        SELECT rebalance_date, year(rebalance_date) * 12 + month(rebalance_date) AS month_idx
        FROM months WHERE mon < (SELECT max(mon) FROM months)""",
    "paired": """
        SELECT r.ticker, r.trade_date, r.adj_close, r.ret_1d, m.mkt_ret
        FROM returns r LEFT JOIN market m ON m.trade_date = r.trade_date""",
    "windows": """
        SELECT ticker, trade_date, adj_close,
               lag(adj_close, 21) OVER t AS p21, trade_date - lag(trade_date, 21) OVER t AS d21,
               lag(adj_close, 252) OVER t AS p252, trade_date - lag(trade_date, 252) OVER t AS d252,
               count(ret_1d) OVER v AS v_n, stddev_samp(ret_1d) OVER v AS v_sd,
               regr_count(ret_1d, mkt_ret) OVER b AS b_n, covar_pop(ret_1d, mkt_ret) OVER b AS b_cov,
               regr_sxx(ret_1d, mkt_ret) OVER b AS b_sxx
        FROM paired
        WINDOW t AS (PARTITION BY ticker ORDER BY trade_date),
               v AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 62 PRECEDING AND CURRENT ROW),
               b AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)""",
    "signals": """
        SELECT ticker, trade_date,
               CASE WHEN d21 BETWEEN 26 AND 40 AND d252 BETWEEN 340 AND 400 THEN p21 / p252 - 1 END AS mom_12_1,
               CASE WHEN d21 BETWEEN 26 AND 40 THEN adj_close / p21 - 1 END AS rev_21d,
               CASE WHEN v_n = 63 THEN v_sd * sqrt(252) END AS vol_63d,
               CASE WHEN b_n = 252 THEN b_cov / nullif(b_sxx / 252, 0) END AS beta_252d
        FROM windows""",
    # fixed values: names, directions and definitions of the factors
    "dim_factor": """
        SELECT * FROM (VALUES
          ('mom_12_1', 'Momentum (12-1)', 1, 'Price(t-21d) / Price(t-252d) - 1; skips most recent month'),
          ('rev_21d', 'Short-term reversal (1M)', -1, 'Price(t) / Price(t-21d) - 1; losers score high'),
          ('vol_63d', 'Low volatility (63d)', -1, 'Annualised stdev of daily returns over 63 obs; low vol scores high'),
          ('beta_252d', 'Low beta (252d)', -1, 'Beta vs equal-weight universe return over 252 obs; low beta scores high')
        ) AS f(factor, label, direction, definition)""",
    "signals_long": """
        SELECT ticker, trade_date AS rebalance_date, factor, raw_value
        FROM (SELECT * FROM signals WHERE trade_date IN (SELECT rebalance_date FROM rebalance_dates))
        UNPIVOT (raw_value FOR factor IN (mom_12_1, rev_21d, vol_63d, beta_252d))""",
    "moments": """
        SELECT rebalance_date, factor, count(*) AS n_names, avg(raw_value) AS mu, stddev_samp(raw_value) AS sd
        FROM signals_long GROUP BY ALL""",
    "zscores": """
        SELECT l.ticker, l.rebalance_date, l.factor, l.raw_value, m.n_names, (l.raw_value - m.mu) / nullif(m.sd, 0) AS z_raw
        FROM signals_long l JOIN moments m USING (rebalance_date, factor)""",
    "scores": """
        SELECT z.ticker, z.rebalance_date, z.factor, z.raw_value, z.n_names, g.direction,
               greatest(-3, least(3, z.z_raw)) * g.direction AS score
        FROM zscores z JOIN dim_factor g USING (factor)
        WHERE z.z_raw IS NOT NULL AND z.n_names >= 5""",
    "month_px": """
        SELECT r.ticker, r.adj_close, d.rebalance_date, d.month_idx
        FROM returns r JOIN rebalance_dates d ON d.rebalance_date = r.trade_date""",
    "fwd_returns": """
        SELECT ticker, rebalance_date,
               max(adj_close) OVER (PARTITION BY ticker ORDER BY month_idx RANGE BETWEEN 1 FOLLOWING AND 1 FOLLOWING)
                 / adj_close - 1 AS fwd_ret_1m
        FROM month_px""",
    "mart_scores_monthly": """
        SELECT s.ticker, s.rebalance_date, s.factor, s.raw_value, s.score,
               ntile(5) OVER (PARTITION BY s.rebalance_date, s.factor ORDER BY s.score, s.ticker) AS quintile, f.fwd_ret_1m
        FROM scores s LEFT JOIN fwd_returns f USING (ticker, rebalance_date)""",
}


def _marts(prefix: str, source: str) -> dict[str, str]:
    """Marts on top of ``source``, a mart_scores_monthly."""
    return {
        f"{prefix}mart_factor_returns": f"""
        SELECT rebalance_date, factor,
               avg(fwd_ret_1m) FILTER (WHERE quintile = 1) AS q1_ret, avg(fwd_ret_1m) FILTER (WHERE quintile = 2) AS q2_ret,
               avg(fwd_ret_1m) FILTER (WHERE quintile = 3) AS q3_ret, avg(fwd_ret_1m) FILTER (WHERE quintile = 4) AS q4_ret,
               avg(fwd_ret_1m) FILTER (WHERE quintile = 5) AS q5_ret,
               avg(fwd_ret_1m) FILTER (WHERE quintile = 5) - avg(fwd_ret_1m) FILTER (WHERE quintile = 1) AS ls_ret,
               count(*) AS n_names
        FROM {source} WHERE fwd_ret_1m IS NOT NULL GROUP BY ALL""",
        f"{prefix}ranked": f"""
        SELECT rebalance_date, factor, rank() OVER (PARTITION BY rebalance_date, factor ORDER BY score) AS rs,
               rank() OVER (PARTITION BY rebalance_date, factor ORDER BY fwd_ret_1m) AS rf
        FROM {source} WHERE fwd_ret_1m IS NOT NULL""",
        f"{prefix}mart_ic": f"""
        SELECT rebalance_date, factor,
               CASE WHEN stddev_pop(rs) > 0 AND stddev_pop(rf) > 0 THEN corr(rs, rf) END AS ic, count(*) AS n_names
        FROM {prefix}ranked GROUP BY ALL""",
        f"{prefix}mart_factor_summary": f"""
        SELECT factor, f.n_months, f.m * 12 AS ann_ls_return, f.sd * sqrt(12) AS ann_ls_vol,
               f.m * 12 / nullif(f.sd * sqrt(12), 0) AS ls_sharpe, f.hits / f.n_months AS hit_rate,
               i.m AS mean_ic, i.m / nullif(i.sd, 0) AS icir
        FROM (SELECT factor, count(*) AS n_months, avg(ls_ret) AS m, stddev_samp(ls_ret) AS sd,
                     count(*) FILTER (WHERE ls_ret > 0) AS hits FROM {prefix}mart_factor_returns GROUP BY factor) f
        JOIN (SELECT factor, avg(ic) AS m, stddev_samp(ic) AS sd FROM {prefix}mart_ic GROUP BY factor) i USING (factor)""",
        f"{prefix}dim_month": f"""
        SELECT rebalance_date AS month_end, year(rebalance_date) AS yr, month(rebalance_date) AS mth
        FROM {source} GROUP BY rebalance_date""",
    }


_RESTATED = {
    "restated": """
        SELECT ticker, rebalance_date, factor, raw_value,
               CASE WHEN factor = 'vol_63d' THEN score * 1.04 ELSE score END AS score,
               CASE WHEN month(rebalance_date) = 7 AND quintile = 4 THEN 2 ELSE quintile END AS quintile,
               CASE WHEN NOT (factor = 'rev_21d' AND quintile = 3) THEN fwd_ret_1m END AS fwd_ret_1m
        FROM mart_scores_monthly WHERE month(rebalance_date) <> 2""",
    **_marts("b_", "restated"),
}

_DAMAGED = {
    "repeated": """
        SELECT * FROM mart_scores_monthly
        UNION ALL SELECT * FROM mart_scores_monthly WHERE month(rebalance_date) = 6""",
    "damaged": """
        SELECT ticker, rebalance_date, factor, raw_value,
               CASE WHEN month(rebalance_date) = 5 THEN score * 4 ELSE score END AS score,
               CASE month(rebalance_date) WHEN 12 THEN 6 - quintile WHEN 4 THEN greatest(quintile, 2) ELSE quintile END AS quintile,
               fwd_ret_1m * 5 AS fwd_ret_1m
        FROM repeated WHERE factor <> 'beta_252d' OR rebalance_date >= DATE '2001-01-01'""",
    **_marts("d_", "damaged"),
}

_QUOTES = {
    "quotes": r"""
        SELECT CASE WHEN l_linenumber = 1 THEN '  ' || lower(t) || chr(9) WHEN l_linenumber = 2 THEN lower(t)
                    WHEN l_orderkey % 83 <> 0 THEN t END AS ticker,
               CASE WHEN l_orderkey % 97 = 0 THEN 'n.d.' WHEN l_orderkey % 7 = 0 THEN d || ' 17:30:00'
                    WHEN l_orderkey % 11 = 0 THEN replace(d, '-', '')
                    WHEN l_orderkey % 13 = 0 THEN strftime(l_shipdate, '%b %-d, %Y')
                    WHEN l_orderkey % 89 <> 0 THEN d END AS trade_date,
               CASE WHEN l_orderkey % 101 = 0 THEN 'n/a' WHEN l_orderkey % 103 = 0 THEN '-' || p
                    WHEN l_orderkey % 107 = 0 THEN 'NaN' ELSE p END AS adj_close
        FROM (SELECT *, 'S' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') AS t, strftime(l_shipdate, '%Y-%m-%d') AS d,
                     CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS VARCHAR) AS p
              FROM lineitem)""",
    "normalized": r"""
        SELECT upper(regexp_replace(ticker, '^\s+|\s+$', '', 'g')) AS ticker,
               CAST(CASE WHEN regexp_full_match(trade_date, '[0-9]{8}') THEN try_strptime(trade_date, '%Y%m%d')
                         WHEN trade_date LIKE '%, %' THEN try_strptime(trade_date, '%b %-d, %Y')
                         ELSE try_cast(trade_date AS TIMESTAMP) END AS DATE) AS trade_date,
               CASE WHEN NOT isnan(try_cast(adj_close AS DOUBLE)) THEN try_cast(adj_close AS DOUBLE) END AS adj_close
        FROM quotes""",
    "complete": """
        SELECT * FROM normalized WHERE ticker IS NOT NULL AND trade_date IS NOT NULL AND adj_close IS NOT NULL""",
    "clashes": """
        SELECT max(adj_close) - min(adj_close) AS reach, abs(min(adj_close)) AS base
        FROM complete GROUP BY ticker, trade_date HAVING count(*) > 1""",
}

_STAR = {
    "fact": """
        SELECT l_suppkey AS security_key, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
                 / CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 100 AS adj_close
        FROM lineitem GROUP BY 1, 2""",
    "dim_security": """
        SELECT s_suppkey AS security_key,
               'S' || lpad(CAST(s_suppkey - CAST(s_suppkey % 10 = 9 AS BIGINT) AS VARCHAR), 12, '0') AS ticker
        FROM supplier""",
    "dim_date": """
        SELECT DISTINCT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(l_shipdate AS DATE) AS date,
               isodow(CAST(l_shipdate AS DATE)) <= 5 AS is_trading_day
        FROM lineitem""",
    "consensus": """
        SELECT s.ticker, d.date AS trade_date, f.adj_close
        FROM fact f, dim_security s, dim_date d
        WHERE f.security_key = s.security_key AND f.date_key = d.date_key AND d.is_trading_day""",
}


def _r(*columns: str) -> str:
    """Rounded columns under their own names."""
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in columns)


def _r10(*columns: str) -> str:
    """The same after ten significant digits."""
    return ", ".join(f"round(CAST(format('{{:.9e}}', {c}) AS DOUBLE), 6) + 0.0 AS {c}" for c in columns)


def _i(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)


_QUINTILE_RETURNS = ("q1_ret", "q2_ret", "q3_ret", "q4_ret", "q5_ret", "ls_ret")
_SUMMARY = ("ann_ls_return", "ann_ls_vol", "ls_sharpe", "hit_rate", "mean_ic", "icir")
_SCORE_ROWS = f"SELECT ticker, rebalance_date, factor, {_r('raw_value', 'score', 'fwd_ret_1m')}, {_i('quintile')}"
_TSTATS = "ls_sharpe * sqrt(n_months / 12) AS t_ls, icir * sqrt(n_months) AS t_ic"


def _check(name: str, severity: str, n_bad: str, text: str, source: str = "") -> str:
    """A check row; ``n_bad`` is an expression over ``source``."""
    return f"""SELECT '{name}' AS "check", '{severity}' AS severity, CAST(n_bad AS BIGINT) AS n_bad, {text} AS detail
        FROM (SELECT {n_bad} AS n_bad {source})"""


def _checks(p: str, mart: str) -> dict[str, str]:
    """Check rows for the marts with prefix ``p`` on top of ``mart``."""

    def counted(name: str, severity: str, rows: str, text: str) -> str:
        return _check(name, severity, "count(*)", f"n_bad || ' {text}'", f"FROM ({rows})")

    sizes = f"SELECT rebalance_date, factor, quintile, count(*) AS n, avg(score) AS m FROM {mart} GROUP BY ALL"
    span = "(year(max(trade_date)) - year(min(trade_date))) * 12 + month(max(trade_date)) - month(min(trade_date)) + 1"
    return {
        "duplicates": counted(
            "duplicates",
            "fail",
            f"SELECT 1 FROM {mart} GROUP BY ticker, rebalance_date, factor HAVING count(*) > 1",
            "duplicate (ticker, rebalance_date, factor) keys in mart_scores_monthly",
        ),
        "factor_coverage": f"""
        SELECT 'factor_coverage' AS "check", 'fail' AS severity, CAST(abs(m - d) AS BIGINT) AS n_bad,
               'mart_factor_summary has ' || m || ' factors, dim_factor has ' || d AS detail
        FROM (SELECT (SELECT count(*) FROM {p}mart_factor_summary) AS m, (SELECT count(*) FROM dim_factor) AS d)""",
        "winsor_band": counted(
            "winsor_band",
            "fail",
            f"SELECT 1 FROM {mart} WHERE score NOT BETWEEN -3.000001 AND 3.000001",
            "scores outside the +/-3 band",
        ),
        "quintile_balance": counted(
            "quintile_balance",
            "fail",
            f"SELECT 1 FROM ({sizes}) GROUP BY rebalance_date, factor HAVING max(n) > min(n) + 1",
            "factor-months with quintile sizes more than 1 apart",
        ),
        "quintile_order": counted(
            "quintile_order",
            "fail",
            f"SELECT 1 FROM ({sizes}) t JOIN ({sizes}) b USING (rebalance_date, factor) "
            "WHERE t.quintile = 5 AND b.quintile = 1 AND t.m <= b.m",
            "factor-months whose top quintile scores no higher than the bottom one",
        ),
        "extreme_returns": counted(
            "extreme_returns",
            "warn",
            f"SELECT DISTINCT ticker, rebalance_date FROM {mart} WHERE abs(fwd_ret_1m) > 0.8",
            "ticker-months with a forward return beyond +/-80%: inspect them",
        ),
        "history_coverage": f"""
        SELECT 'history_coverage' AS "check", 'warn' AS severity, CAST(scored < 0.75 * span AS BIGINT) AS n_bad,
               scored || ' of ' || span || ' calendar months in the raw price range are scored' AS detail
        FROM (SELECT (SELECT count(DISTINCT rebalance_date) FROM {mart}) AS scored,
                     (SELECT {span} FROM raw_prices) AS span)""",
        "thin_history": counted(
            "thin_history",
            "warn",
            f"SELECT 1 FROM {p}mart_factor_summary WHERE n_months < 24",
            "factors with fewer than 24 monthly observations",
        ),
    }


_PARITY_ROWS = """
        SELECT count(*) FILTER (WHERE a.ticker IS NULL OR b.ticker IS NULL) AS n_one_sided,
                        count(*) FILTER (WHERE a.ticker = b.ticker) AS n_pairs,
                        count(*) FILTER (WHERE a.ticker = b.ticker AND a.quintile IS DISTINCT FROM b.quintile) AS n_quintile_diff,
                        max(abs(a.score - b.score)) AS s, max(abs(a.fwd_ret_1m - b.fwd_ret_1m)) AS f,
                        count(*) FILTER (WHERE a.ticker = b.ticker AND (a.fwd_ret_1m IS NULL) <> (b.fwd_ret_1m IS NULL))
                          + count(*) FILTER (WHERE a.ticker = b.ticker AND (a.score IS NULL) <> (b.score IS NULL))
                          AS n_null_mismatch
                 FROM mart_scores_monthly a FULL JOIN restated b
                   ON a.ticker = b.ticker AND a.rebalance_date = b.rebalance_date AND a.factor = b.factor"""

_UNALTERED = ("raw_prices", "dim_factor", "returns", "market", "rebalance_dates", "signals", "scores", "fwd_returns")


def _parity() -> str:
    """All three comparisons as (section, item, difference, same)."""
    rows = _PARITY_ROWS
    items = " UNION ALL ".join(
        f"""SELECT 'score rows' AS section, '{c}' AS item, CAST({c} AS DOUBLE) AS difference,
            coalesce({c} <= {limit}, false) AS same FROM ({rows})"""
        for c, limit in (("n_one_sided", 0), ("n_quintile_diff", 0), ("s", 1e-9), ("f", 1e-9))
    ).replace("'s' AS item", "'max_score_diff' AS item").replace("'f' AS item", "'max_fwd_diff' AS item")
    return f"""
        SELECT section, item, round(difference, 6) + 0.0 AS difference, same FROM (
        SELECT 'row counts' AS section, table_name AS item, CAST(abs(n_a - n_b) AS DOUBLE) AS difference, same
        FROM ({_parity_counts()})
        UNION ALL SELECT 'factor summary', metric, max_diff, same FROM ({_parity_summary()})
        UNION ALL {items})"""


def _parity_counts() -> str:
    sides = {
        **{t: t for t in _UNALTERED},
        "mart_scores_monthly": "restated",
        "mart_factor_returns": "b_mart_factor_returns",
        "mart_ic": "b_mart_ic",
        "mart_factor_summary": "b_mart_factor_summary",
        "dim_month": "b_dim_month",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS table_name, (SELECT count(*) FROM {a}) AS n_a, (SELECT count(*) FROM {b}) AS n_b"
        for a, b in sides.items()
    )
    return f"SELECT *, n_a = n_b AS same FROM ({rows})"


def _parity_summary() -> str:
    metrics = ("n_months", *_SUMMARY)
    rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS metric, max(abs(a.{c} - b.{c})) AS d, max(abs(a.{c})) AS top,
            count(*) FILTER (WHERE a.factor IS NULL OR b.factor IS NULL) AS n_one_sided
            FROM mart_factor_summary a FULL JOIN b_mart_factor_summary b ON a.factor = b.factor"""
        for c in metrics
    )
    return f"""SELECT metric, round(d, 6) + 0.0 AS max_diff, n_one_sided,
        d <= greatest(1e-9, 1e-9 * top) AND n_one_sided = 0 AS same FROM ({rows})"""


def _measures(returns_where: str, ic_where: str, key: str) -> str:
    return f"""
        SELECT {f'r.k AS {key}, ' if key else ''}m AS ls_return_month, m * 12 AS ann_ls_return, sd * sqrt(12) AS ann_ls_vol,
               m * 12 / nullif(sd * sqrt(12), 0) AS ls_sharpe, hits / n AS hit_rate, im AS mean_ic, im / nullif(isd, 0) AS icir
        FROM (SELECT {key or '1'} AS k, avg(ls_ret) AS m, stddev_samp(ls_ret) AS sd, count(*) AS n,
                     count(*) FILTER (WHERE ls_ret > 0) AS hits FROM mart_factor_returns WHERE {returns_where} GROUP BY 1) r
        JOIN (SELECT {key or '1'} AS k, avg(ic) AS im, stddev_samp(ic) AS isd FROM mart_ic WHERE {ic_where} GROUP BY 1) i
          ON i.k = r.k"""


def _measure_columns(key: str = "") -> str:
    return ", ".join(filter(None, [key, _r("ls_return_month", *_SUMMARY)]))


def _manifest() -> str:
    items = {
        "raw_rows": "SELECT count(*) FROM raw_prices",
        "raw_tickers": "SELECT count(DISTINCT ticker) FROM raw_prices",
        "raw_first": "SELECT min(trade_date) FROM raw_prices",
        "raw_last": "SELECT max(trade_date) FROM raw_prices",
        "scored_first": "SELECT min(rebalance_date) FROM mart_factor_returns",
        "scored_last": "SELECT max(rebalance_date) FROM mart_factor_returns",
        "scored_months": "SELECT count(DISTINCT rebalance_date) FROM mart_ic",
        **{
            f"rows_{t}": f"SELECT count(*) FROM {t}"
            for t in ("mart_factor_summary", "mart_factor_returns", "mart_ic", "dim_factor")
        },
    }
    return " UNION ALL ".join(f"SELECT '{k}' AS item, CAST(({q}) AS VARCHAR) AS value" for k, q in items.items())


_POSITION = "CASE factor WHEN 'mom_12_1' THEN 1 WHEN 'rev_21d' THEN 2 WHEN 'vol_63d' THEN 3 WHEN 'beta_252d' THEN 4 ELSE 5 END"
_SPINE_GROWTH = "round(product(coalesce(1 + ls_ret, 1)) OVER (PARTITION BY factor ORDER BY month_end) - 1, 6) + 0.0 AS cum_spread"

_RUN = {**_DENSE, **_MODEL, **_marts("", "mart_scores_monthly")}
_SIGNAL_COLUMNS = ("mom_12_1", "rev_21d", "vol_63d", "beta_252d")

# query -> (tables to build, statement)
_STATEMENTS: dict[str, tuple[dict[str, str], str]] = {
    "src_parquet": (
        {},
        f"""SELECT l_orderkey, {_i('l_linenumber')}, l_suppkey, CAST(l_shipdate AS DATE) AS ship_date,
            l_extendedprice FROM lineitem""",
    ),
    "price_panel": (_DENSE, "SELECT ticker, trade_date, adj_close FROM raw_prices"),
    "price_panel_sparse": (_SPARSE, "SELECT ticker, trade_date, adj_close FROM raw_prices"),
    "consensus_prices": (_STAR, "SELECT ticker, trade_date, adj_close FROM consensus"),
    "panel_profile": (
        _DENSE,
        """SELECT count(*) AS n_rows, count(DISTINCT ticker) AS n_tickers, min(trade_date) AS first_date,
           max(trade_date) AS last_date FROM raw_prices""",
    ),
    "contract_normalize": (_QUOTES, "SELECT ticker, trade_date, adj_close FROM normalized"),
    "contract_violations": (
        _QUOTES,
        """SELECT (SELECT count(*) FROM normalized WHERE ticker IS NULL) AS null_ticker,
                  (SELECT count(*) FROM normalized WHERE trade_date IS NULL) AS null_trade_date,
                  (SELECT count(*) FROM normalized WHERE adj_close IS NULL) AS null_adj_close,
                  (SELECT count(*) FROM complete) AS complete_rows,
                  (SELECT count(*) FROM complete WHERE adj_close <= 0) AS nonpositive,
                  (SELECT count(*) FROM clashes) AS duplicate_groups,
                  round((SELECT max(reach / base) FROM clashes WHERE base > 0), 6) + 0.0 AS worst_spread""",
    ),
    "contract_report": (
        _QUOTES,
        """SELECT rule, "column", CAST(n_rows AS BIGINT) AS n_rows, round(worst, 6) + 0.0 AS worst, passes FROM (
           SELECT 'parseable' AS rule, 'ticker' AS "column", count(*) AS n_rows, CAST(NULL AS DOUBLE) AS worst,
                  count(*) = 0 AS passes FROM normalized WHERE ticker IS NULL
           UNION ALL SELECT 'parseable', 'trade_date', count(*), NULL, count(*) = 0 FROM normalized WHERE trade_date IS NULL
           UNION ALL SELECT 'parseable', 'adj_close', count(*), NULL, count(*) = 0 FROM normalized WHERE adj_close IS NULL
           UNION ALL SELECT 'positive', 'adj_close', count(*), NULL, count(*) = 0 FROM complete WHERE adj_close <= 0
           UNION ALL SELECT 'unique', 'ticker, trade_date', count(*), max(reach / base) FILTER (WHERE base > 0),
                  count(*) = 0 OR coalesce(max(reach / base) FILTER (WHERE base > 0) <= 1e-5, false) FROM clashes
           UNION ALL SELECT 'not empty', NULL, count(*), NULL, count(*) > 0 FROM complete)""",
    ),
    "src_csv": (
        _SPARSE,
        """SELECT CASE WHEN damage IS NOT NULL THEN NULL WHEN d = 27 THEN ticker || ', "B"' ELSE ticker END AS ticker,
                  CASE WHEN damage IS NULL THEN trade_date END AS trade_date,
                  CASE WHEN damage IS NULL THEN adj_close END AS adj_close, damage AS bad_line
           FROM (SELECT *, day(trade_date) AS d, CASE day(trade_date) WHEN 9 THEN ticker || ',' || trade_date
                        WHEN 16 THEN ticker || ',' || trade_date || ',1,2'
                        WHEN 23 THEN ticker || ',"' || trade_date || ',1' END AS damage FROM raw_prices)""",
    ),
    "adhoc_sql": (
        _RUN,
        """SELECT d.label, count(*) AS n_months, count(*) FILTER (WHERE f.ls_ret > 0) AS n_hits,
                  round(max(f.ls_ret), 6) + 0.0 AS best_month
           FROM mart_factor_returns f, dim_factor d WHERE f.factor = d.factor GROUP BY d.label""",
    ),
    "pipeline_rebuild_month": (_RUN, f"{_SCORE_ROWS} FROM mart_scores_monthly"),
    "scores_with_forward": (
        _RUN,
        f"""SELECT ticker, rebalance_date, factor, {_r('raw_value')}, n_names, {_i('direction')}, {_r('score', 'fwd_ret_1m')}
            FROM scores LEFT JOIN fwd_returns USING (ticker, rebalance_date)""",
    ),
    "contract_dup_groups": (
        _STAR,
        """SELECT ticker, trade_date, count(*) AS n_prices, min(adj_close) AS min_price,
                  max(adj_close) AS max_price,
                  round((max(adj_close) - min(adj_close)) / nullif(abs(min(adj_close)), 0), 6) + 0.0 AS spread
           FROM consensus GROUP BY ticker, trade_date HAVING count(*) > 1""",
    ),
    "pipeline_build": (_RUN, f"SELECT factor, n_months, {_r(*_SUMMARY)} FROM mart_factor_summary"),
    "export_factor_summary": (_RUN, f"SELECT factor, n_months, {_r10(*_SUMMARY)} FROM mart_factor_summary"),
    "export_factor_returns": (
        {**_RUN, **_DAMAGED},
        f"SELECT rebalance_date, factor, {_r10(*_QUINTILE_RETURNS)}, n_names FROM d_mart_factor_returns",
    ),
    # the second price of a near-duplicate is the higher one, so the original panel remains
    "contract_dedup": (_SPARSE, "SELECT ticker, trade_date, adj_close FROM raw_prices"),
    "daily_returns": (_RUN, f"SELECT ticker, trade_date, adj_close, {_r('ret_1d')} FROM returns"),
    "daily_returns_sparse": ({**_SPARSE, **_MODEL}, f"SELECT ticker, trade_date, adj_close, {_r('ret_1d')} FROM returns"),
    "market_proxy": (_RUN, f"SELECT trade_date, {_r('mkt_ret')}, n_names FROM market"),
    "returns_vs_market": (
        _RUN,
        f"""SELECT ticker, trade_date, adj_close, {_r('ret_1d')},
            CASE WHEN mkt_ret IS NOT NULL THEN round(ret_1d, 6) + 0.0 END AS ret_b,
            CASE WHEN ret_1d IS NOT NULL THEN round(mkt_ret, 6) + 0.0 END AS mkt_b FROM paired""",
    ),
    "signal_momentum": (_RUN, f"SELECT ticker, trade_date, {_r('mom_12_1')} FROM signals"),
    "signal_reversal": (_RUN, f"SELECT ticker, trade_date, {_r('rev_21d')} FROM signals"),
    "signal_volatility": (_RUN, f"SELECT ticker, trade_date, {_r('vol_63d')} FROM signals"),
    "signal_beta": (_RUN, f"SELECT ticker, trade_date, {_r('beta_252d')} FROM signals"),
    "signals": (_RUN, f"SELECT ticker, trade_date, {_r(*_SIGNAL_COLUMNS)} FROM signals"),
    "signals_with_gaps": ({**_GAPPY, **_MODEL}, f"SELECT ticker, trade_date, {_r(*_SIGNAL_COLUMNS)} FROM signals"),
    "rebalance_dates": (_RUN, f"SELECT rebalance_date, {_i('month_idx')} FROM rebalance_dates"),
    "signals_long": (_RUN, f"SELECT ticker, rebalance_date, factor, {_r('raw_value')} FROM signals_long"),
    "zscores": (_RUN, f"SELECT ticker, rebalance_date, factor, {_r('raw_value', 'z_raw')}, n_names FROM zscores"),
    "winsorized_scores": (_RUN, f"SELECT ticker, rebalance_date, factor, {_r('score')} FROM scores"),
    "scores": (
        _RUN,
        f"""SELECT ticker, rebalance_date, factor, {_r('raw_value')}, n_names, {_i('direction')}, {_r('score')} FROM scores""",
    ),
    "forward_returns": (_RUN, f"SELECT ticker, rebalance_date, {_r('fwd_ret_1m')} FROM fwd_returns"),
    "forward_returns_with_gaps": (
        {**_GAPPY, **_MODEL},
        f"SELECT ticker, rebalance_date, {_r('fwd_ret_1m')} FROM fwd_returns",
    ),
    "mart_scores_monthly": (_RUN, f"{_SCORE_ROWS} FROM mart_scores_monthly"),
    "mart_factor_returns": (
        _RUN,
        f"SELECT rebalance_date, factor, {_r(*_QUINTILE_RETURNS)}, n_names FROM mart_factor_returns",
    ),
    "mart_ic": (_RUN, f"SELECT rebalance_date, factor, {_r('ic')}, n_names FROM mart_ic"),
    "mart_factor_summary": (_RUN, f"SELECT factor, n_months, {_r(*_SUMMARY)} FROM mart_factor_summary"),
    "dim_month": (_RUN, f"SELECT month_end, {_i('yr', 'mth')} FROM dim_month"),
    "mart_window": (
        _RUN,
        """SELECT min(rebalance_date) AS first_month, max(rebalance_date) AS last_month,
           count(DISTINCT rebalance_date) AS n_months FROM mart_scores_monthly""",
    ),
    "run_manifest": (_RUN, _manifest()),
    **{f"check_{name}": (_RUN, sql) for name, sql in _checks("", "mart_scores_monthly").items()},
    "checks_damaged_run": ({**_RUN, **_DAMAGED}, " UNION ALL ".join(_checks("d_", "damaged").values())),
    "parity_counts": ({**_RUN, **_RESTATED}, _parity_counts()),
    "parity_keys": (
        {**_RUN, **_RESTATED},
        """SELECT CASE WHEN b.ticker IS NULL THEN 'only_a' WHEN a.ticker IS NULL THEN 'only_b' ELSE 'both' END AS side,
                  count(*) AS n_keys
           FROM mart_scores_monthly a FULL JOIN restated b
             ON a.ticker = b.ticker AND a.rebalance_date = b.rebalance_date AND a.factor = b.factor
           GROUP BY 1""",
    ),
    "parity_summary": ({**_RUN, **_RESTATED}, _parity_summary()),
    "parity_rows": (
        {**_RUN, **_RESTATED},
        f"""SELECT n_one_sided, n_pairs, n_quintile_diff, round(s, 6) + 0.0 AS max_score_diff,
                  round(f, 6) + 0.0 AS max_fwd_diff, n_null_mismatch,
                  n_one_sided = 0 AND n_quintile_diff = 0 AND s <= 1e-9 AND f <= 1e-9 AS same
           FROM ({_PARITY_ROWS})""",
    ),
    "parity": ({**_RUN, **_RESTATED}, _parity()),
    "factor_order": (_RUN, f"SELECT factor, row_number() OVER (ORDER BY {_POSITION}, factor) AS position FROM mart_factor_summary"),
    "factor_tstats": (
        _RUN,
        f"SELECT factor, n_months, {_r('t_ls', 't_ic')} FROM (SELECT *, {_TSTATS} FROM mart_factor_summary)",
    ),
    "factor_significance": (
        _RUN,
        f"""SELECT factor, n_months, {_r('t_ls', 't_ic')},
            CASE WHEN abs(t_ls) >= 2 THEN 'spread' WHEN abs(t_ls) < 2 AND abs(t_ic) >= 2 THEN 'ic_only'
                 WHEN abs(t_ls) < 2 AND abs(t_ic) < 2 THEN 'flat' END AS verdict
            FROM (SELECT *, {_TSTATS} FROM mart_factor_summary)""",
    ),
    "results_table": (
        _RUN,
        f"""SELECT row_number() OVER (ORDER BY {_POSITION}, factor) AS position, label, n_months AS months,
            round(ann_ls_return * 100, 6) + 0.0 AS ann_ls_return_pct, round(ann_ls_vol * 100, 6) + 0.0 AS ann_ls_vol_pct,
            {_r('ls_sharpe')}, round(hit_rate * 100, 6) + 0.0 AS hit_rate_pct, {_r('mean_ic', 'icir', 't_ls', 't_ic')}
            FROM (SELECT *, {_TSTATS} FROM mart_factor_summary) JOIN dim_factor USING (factor)""",
    ),
    "ic_tstats": (
        _RUN,
        """SELECT factor, count(*) AS n_months, round(avg(ic), 6) + 0.0 AS mean_ic,
                  round(avg(ic) / nullif(stddev_samp(ic), 0) * sqrt(count(*)), 6) + 0.0 AS t_ic
           FROM mart_ic GROUP BY factor""",
    ),
    "ic_rolling_12m": (
        _RUN,
        f"""SELECT rebalance_date, factor, {_r('ic')},
                  CASE WHEN count(ic) OVER w = 12 THEN round(avg(ic) OVER w, 6) + 0.0 END AS ic_mean_12m
           FROM mart_ic
           WINDOW w AS (PARTITION BY factor ORDER BY rebalance_date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
    ),
    "cumulative_spread": (
        _RUN,
        f"""SELECT rebalance_date, factor, {_r('ls_ret')},
            CASE WHEN ls_ret IS NOT NULL
                 THEN round(product(1 + ls_ret) OVER (PARTITION BY factor ORDER BY rebalance_date) - 1, 6) + 0.0 END AS cum_spread
            FROM mart_factor_returns""",
    ),
    "cumulative_spread_spine": (
        _RUN,
        f"""SELECT month_end, factor, {_SPINE_GROWTH}
            FROM (SELECT m.month_end, m.factor, r.ls_ret
                  FROM (SELECT month_end, unnest((SELECT list(factor) FROM dim_factor)) AS factor FROM dim_month) m
                  LEFT JOIN mart_factor_returns r ON r.rebalance_date = m.month_end AND r.factor = m.factor)""",
    ),
    "cumulative_spread_mean": (
        _RUN,
        f"""SELECT month_end, factor, {_SPINE_GROWTH}
            FROM (SELECT m.month_end, 'all' AS factor, avg(r.ls_ret) AS ls_ret FROM dim_month m
                  LEFT JOIN mart_factor_returns r ON r.rebalance_date = m.month_end GROUP BY m.month_end)""",
    ),
    "quintile_profile": (
        _RUN,
        " UNION ALL ".join(
            f"""SELECT factor, CAST({q} AS BIGINT) AS quintile, round(avg(q{q}_ret), 6) + 0.0 AS mean_ret
                FROM mart_factor_returns GROUP BY factor"""
            for q in range(1, 6)
        ),
    ),
    "factor_measures": (
        _RUN,
        f"SELECT {_measure_columns('factor')} FROM ("
        + _measures(*["rebalance_date BETWEEN DATE '1997-01-01' AND DATE '2000-12-31'"] * 2, "factor")
        + ")",
    ),
    "factor_measures_total": (
        _RUN,
        f"SELECT {_measure_columns()} FROM (" + _measures(*["factor IN ('rev_21d', 'vol_63d')"] * 2, "") + ")",
    ),
    "reconciliation": (
        {**_RUN, "measures": _measures("true", "true", "factor")},
        " UNION ALL ".join(
            f"""SELECT m.factor, '{c}' AS measure, round(m.{c} - s.{c}, 6) + 0.0 AS diff
                FROM measures m JOIN mart_factor_summary s ON s.factor = m.factor"""
            for c in _SUMMARY
        ),
    ),
    "star_view": (
        _RUN,
        f"""SELECT r.rebalance_date, r.factor, {_r(*(f'r.{c}' for c in _QUINTILE_RETURNS)).replace('AS r.', 'AS ')}, r.n_names,
            g.label, {_i('direction')}, g.definition, {_i('yr', 'mth')}
            FROM mart_factor_returns r JOIN dim_factor g ON g.factor = r.factor JOIN dim_month d ON d.month_end = r.rebalance_date""",
    ),
    "star_orphans": (
        _RUN,
        " UNION ALL ".join(
            f"""SELECT '{t}' AS fact,
                count(*) FILTER (WHERE factor NOT IN (SELECT factor FROM dim_factor)) AS missing_factor,
                count(*) FILTER (WHERE rebalance_date NOT IN (SELECT month_end FROM dim_month)) AS missing_month FROM {t}"""
            for t in ("mart_factor_returns", "mart_ic", "mart_scores_monthly")
        ),
    ),
}


def statements() -> dict[str, str]:
    def complete(tables: dict[str, str], select: str) -> str:
        if not tables:
            return select
        return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in tables.items()) + "\n" + select

    return {name: complete(*parts) for name, parts in _STATEMENTS.items()}
