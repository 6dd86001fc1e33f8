"""The registered queries as standard SQL over the test tables, for comparison."""

from __future__ import annotations

import re

# Relations, each built on the ones before it.
CTES = {
    "raw_tape": """
        SELECT CAST(l_suppkey AS VARCHAR) AS ticker, l_shipdate AS date,
               l_extendedprice / l_quantity AS adj_close,
               CASE WHEN l_discount >= 0.09 THEN l_extendedprice * l_discount ELSE 0.0 END AS dividends,
               l_orderkey * 8 + l_linenumber AS source_rank
        FROM lineitem""",
    "tape": """
        SELECT ticker, date, adj_close, dividends,
               CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
        FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date
                  ORDER BY source_rank, adj_close NULLS LAST, dividends NULLS LAST) AS pos
              FROM raw_tape)
        WHERE pos = 1""",
    "comp": "SELECT * FROM tape WHERE ticker NOT IN ('0', '1')",
    "annual": """
        SELECT ticker, year, sum(dividends) AS annual_dividend,
               count(CASE WHEN dividends > 0 THEN 1 END) AS dividend_frequency
        FROM comp GROUP BY ticker, year""",
    "changes": """
        SELECT *, CASE WHEN dividend_increase > 0 THEN 1 ELSE 0 END AS flag
        FROM (SELECT *, annual_dividend - lag(annual_dividend)
                     OVER (PARTITION BY ticker ORDER BY year) AS dividend_increase
              FROM annual)""",
    "islands": """
        SELECT *, CASE WHEN flag = 1 THEN
                 row_number() OVER (PARTITION BY ticker ORDER BY year)
               - row_number() OVER (PARTITION BY ticker, flag ORDER BY year) END AS island
        FROM changes""",
    "streaks": """
        SELECT *, CASE WHEN flag = 0 THEN 0 ELSE
                 row_number() OVER (PARTITION BY ticker, flag, island ORDER BY year) END AS streak
        FROM islands""",
    "qualified": """
        SELECT ticker, year, dividend_frequency, CAST(streak AS INTEGER) AS consecutive_growth_years,
               pow(last_value(annual_dividend) OVER five / first_value(annual_dividend) OVER five, 0.2) - 1
                   AS five_year_cagr
        FROM streaks WHERE streak >= {min_streak}
        WINDOW five AS (PARTITION BY ticker ORDER BY year ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "growth": "SELECT * FROM qualified WHERE year = 2000",
    "returns": """
        SELECT ticker, date, adj_close,
               CASE WHEN previous <> 0 AND adj_close / previous > 0 THEN ln(adj_close / previous) END AS r
        FROM (SELECT *, lag(adj_close) OVER (PARTITION BY ticker ORDER BY date) AS previous
              FROM tape WHERE date BETWEEN TIMESTAMP '1996-08-02' AND TIMESTAMP '2001-08-01')""",
    "market": "SELECT date, r AS m FROM returns WHERE ticker = '0'",
    "betas": """
        SELECT ticker, covar_pop(r, m) / nullif(var_pop(m), 0) AS beta, regr_slope(r, m) AS paired
        FROM returns JOIN market USING (date)
        WHERE ticker NOT IN ('0', '1') GROUP BY ticker""",
    "latest": """
        SELECT ticker, arg_max_null(adj_close, date) AS last_price,
               arg_max(dividends, date) FILTER (WHERE dividends > 0) AS last_dividend
        FROM comp WHERE date <= TIMESTAMP '2001-08-01' GROUP BY ticker""",
    "histories": """
        SELECT ticker,
               count(CASE WHEN date BETWEEN TIMESTAMP '2001-07-02' AND TIMESTAMP '2001-08-01' THEN 1 END) AS n_prices,
               count(CASE WHEN dividends > 0 THEN 1 END) AS n_dividends,
               max(CASE WHEN date BETWEEN TIMESTAMP '2001-07-02' AND TIMESTAMP '2001-08-01' THEN date END) AS last_price_date
        FROM comp WHERE date BETWEEN TIMESTAMP '2000-08-01' AND TIMESTAMP '2001-08-01' GROUP BY ticker""",
    "companies": """
        SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS name, r_name AS sector, n_name AS industry
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "rates": """
        SELECT ticker, pow(arg_max_null(adj_close, date) / nullif(arg_min_null(adj_close, date), 0), 0.2) - 1
                   AS rate
        FROM tape WHERE ticker = '0' AND date BETWEEN TIMESTAMP '1996-08-02' AND TIMESTAMP '2001-08-01' GROUP BY ticker
        UNION ALL
        SELECT ticker, arg_max_null(adj_close, date) / 100 FROM tape
        WHERE ticker = '1' AND date <= TIMESTAMP '2001-08-01' GROUP BY ticker""",
    "report": """
        SELECT ticker, name, sector, industry, consecutive_growth_years, dividend_frequency, beta,
               five_year_cagr, last_dividend, last_price, n_prices, n_dividends, last_price_date
        FROM growth JOIN betas USING (ticker) JOIN latest USING (ticker)
        JOIN companies USING (ticker) JOIN histories USING (ticker)""",
    "snapshots": """
        SELECT CAST(o_custkey AS VARCHAR) AS symbol, c_name AS security, c_mktsegment AS gics_sector,
               o_orderpriority AS gics_sub_industry,
               CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS updated_at
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "held": """
        SELECT *, dense_rank() OVER (ORDER BY updated_at) AS run
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol, updated_at
                  ORDER BY security NULLS LAST, gics_sector NULLS LAST, gics_sub_industry NULLS LAST) AS pos
              FROM snapshots)
        WHERE pos = 1""",
    "stretches": """
        SELECT *, sum(begins) OVER (PARTITION BY symbol ORDER BY run) AS stretch
        FROM (SELECT *, CASE WHEN lag(run) OVER (PARTITION BY symbol ORDER BY run) = run - 1
                  AND lag((security, gics_sector, gics_sub_industry)) OVER (PARTITION BY symbol ORDER BY run)
                      IS NOT DISTINCT FROM (security, gics_sector, gics_sub_industry)
                  THEN 0 ELSE 1 END AS begins
              FROM held)""",
    "intervals": """
        SELECT symbol, security, gics_sector, gics_sub_industry, valid_from, r.updated_at AS valid_to
        FROM (SELECT symbol, stretch, any_value(security) AS security, any_value(gics_sector) AS gics_sector,
                     any_value(gics_sub_industry) AS gics_sub_industry, min(updated_at) AS valid_from,
                     max(run) AS last_run
              FROM stretches GROUP BY symbol, stretch)
        LEFT JOIN (SELECT DISTINCT run, updated_at FROM held) r ON r.run = last_run + 1""",
    "newest": """
        SELECT symbol AS ticker, security AS name, gics_sector AS sector, gics_sub_industry AS industry
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY updated_at DESC,
                  security NULLS LAST, gics_sector NULLS LAST, gics_sub_industry NULLS LAST) AS pos
              FROM snapshots WHERE updated_at <= TIMESTAMP '2001-08-01')
        WHERE pos = 1""",
    "times": """
        SELECT DISTINCT updated_at FROM snapshots WHERE updated_at <= TIMESTAMP '2001-08-01'
        ORDER BY updated_at DESC LIMIT 2""",
    "now_in": """
        SELECT DISTINCT symbol FROM snapshots WHERE updated_at = (SELECT max(updated_at) FROM times)""",
    "before_in": """
        SELECT DISTINCT symbol FROM snapshots
        WHERE updated_at = (SELECT min(updated_at) FROM times HAVING count(*) = 2)""",
    "fresh": "SELECT symbol FROM now_in EXCEPT SELECT symbol FROM before_in",
    "members": """
        SELECT symbol, name AS security, sector AS gics_sector, industry AS gics_sub_industry,
               TIMESTAMP '2001-08-01' AS updated_at
        FROM now_in JOIN newest ON symbol = ticker
        UNION ALL
        SELECT symbol, security, NULL, NULL, TIMESTAMP '2001-08-01'
        FROM (VALUES ('^TNX', '10 Year Treasury Note'), ('^GSPC', 'S&P 500')) AS b(symbol, security)""",
    "trading_days": """
        SELECT day, row_number() OVER (ORDER BY day) AS number
        FROM (SELECT DISTINCT CAST(date AS DATE) AS day FROM tape
              WHERE ticker = '0' AND date <= TIMESTAMP '2001-08-01')""",
    "lacking": """
        SELECT j.ticker, s.day AS start_date, CAST(e.day + 1 AS DATE) AS end_date,
               j.number - j.previous - 1 AS n_days
        FROM (SELECT ticker, number, lag(number) OVER (PARTITION BY ticker ORDER BY number) AS previous
              FROM (SELECT DISTINCT ticker, number FROM comp JOIN trading_days ON day = CAST(date AS DATE)
                    UNION
                    SELECT ticker, (SELECT max(number) + 1 FROM trading_days) FROM comp
                    JOIN trading_days ON day = CAST(date AS DATE))) j
        JOIN trading_days s ON s.number = j.previous + 1 JOIN trading_days e ON e.number = j.number - 1
        WHERE j.number - j.previous > 1""",
    "event_tape": """
        SELECT CAST(user_id AS VARCHAR) AS ticker, ts AS date, value AS adj_close,
               CAST(0.0 AS DOUBLE) AS dividends
        FROM events""",
}


def _needed(text: str) -> list[str]:
    """Names of the relations that `text` mentions, directly or through others."""
    names: list[str] = []
    for name, body in CTES.items():
        if name not in names and re.search(rf"\b{name}\b", text):
            names += [n for n in _needed(body) + [name] if n not in names]
    return names


def _query(select: str, min_streak: int = 2) -> str:
    wanted = set(_needed(select))
    ctes = ",\n".join(
        f"{name} AS ({body.strip()})" for name, body in CTES.items() if name in wanted
    )
    # A select may bring relations of its own, led by a comma.
    return (f"WITH {ctes}\n{select}" if ctes else select).replace("{min_streak}", str(min_streak))


def six(expression: str) -> str:
    # Adding zero turns a negative zero into a plain one.
    return f"round({expression}, 6) + 0.0"


def oracle_sql() -> dict[str, str]:
    index_growth = (
        "pow(arg_max_null(adj_close, date) / arg_min_null(adj_close, date), "
        "365.0 / date_diff('day', min(date), max(date))) - 1"
    )
    selects = {
        "scan_tape": "SELECT ticker, date, adj_close, dividends FROM raw_tape",
        "scan_mixed_files": "SELECT ticker, date, adj_close, dividends FROM raw_tape",
        "listed_files": "SELECT ticker, date, adj_close, dividends FROM raw_tape",
        "nested_prices": """
            SELECT ticker, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS position,
                   date, adj_close FROM comp
            WHERE date BETWEEN TIMESTAMP '2001-07-02' AND TIMESTAMP '2001-08-01'""",
        "nested_dividends": """
            SELECT ticker, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS position,
                   date, dividends FROM comp
            WHERE dividends > 0
              AND date BETWEEN TIMESTAMP '2000-08-01' AND TIMESTAMP '2001-08-01'""",
        "scan_snapshots": "SELECT * FROM snapshots",
        "normalise_names": """
            SELECT CAST(c_custkey AS INTEGER) AS cust_key, c_name AS security,
                   c_mktsegment AS market_segment, c_acctbal AS acct_bal FROM customer""",
        "registered_rows": """
            SELECT CAST(c_custkey AS INTEGER) AS cust_key, c_name AS security,
                   CASE WHEN c_custkey % 2 = 0 THEN floor(c_acctbal) ELSE c_acctbal END AS acct_bal,
                   CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS market_segment
            FROM customer""",
        "missing_ranges": "SELECT * FROM lacking",
        "fetch_plan_of_gaps": """
            SELECT o.ticker AS symbol, 'daily' AS mode,
                   coalesce(CAST(start_date AS TIMESTAMP), TIMESTAMP '2001-07-31') AS start_date,
                   coalesce(CAST(end_date AS TIMESTAMP), TIMESTAMP '2001-08-01') AS end_date,
                   '2001-08-01-00-00-00-daily.csv' AS output_key
            FROM (SELECT DISTINCT ticker FROM comp) o LEFT JOIN lacking g ON g.ticker = o.ticker""",
        "publish_document": f"""
            SELECT ticker, name, sector, industry,
                   consecutive_growth_years AS streak, dividend_frequency AS payments,
                   {six('beta')} AS beta, {six('five_year_cagr')} AS cagr, last_dividend, last_price,
                   n_prices, n_dividends
            FROM report""",
        "published_rates": f"""
            SELECT ticker, {six('rate')} AS rate, TIMESTAMP '2001-08-01' AS last_updated FROM rates""",
        "worklist_json": """
            SELECT 0 AS section, CAST(NULL AS VARCHAR) AS symbol, '{"New_Tickers": [' AS line
            UNION ALL
            SELECT 1, symbol, CASE WHEN symbol = (SELECT min(symbol) FROM fresh) THEN '' ELSE ',' END
                   || '"' || symbol || '"' FROM fresh
            UNION ALL SELECT 2, NULL, '], "Old_Tickers": ['
            UNION ALL
            SELECT 3, symbol, CASE WHEN symbol = (SELECT min(symbol) FROM before_in) THEN '' ELSE ',' END
                   || '"' || symbol || '"' FROM before_in
            UNION ALL SELECT 4, NULL, ']}'""",
        "read_worklist": """
            SELECT symbol, 'historical' AS mode FROM fresh
            UNION ALL SELECT symbol, 'daily' FROM before_in""",
        "write_snapshot_csv": "SELECT * FROM members",
        "stream_ingest": "SELECT * FROM event_tape",
        "stream_dedupe": "SELECT * FROM event_tape",
        "stream_first_delivery": "SELECT * FROM event_tape",
        "quarantine": """
            WITH judged AS (
                SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS ticker,
                       CASE WHEN value >= 1 THEN ts END AS date,
                       CASE WHEN value < 50 THEN value END AS adj_close,
                       CASE WHEN value >= 30 THEN CAST('NaN' AS DOUBLE)
                            WHEN value >= 5 THEN 0.5 END AS dividends,
                       CASE WHEN event_type = 'error' THEN 'no ticker'
                            WHEN value < 1 THEN 'bad date'
                            WHEN value >= 50 THEN 'bad price'
                            WHEN value >= 30 THEN 'bad dividend' END AS reason
                FROM events)
            SELECT * FROM judged""",
        "replayed_rows": """
            WITH entered AS (
                SELECT CAST(user_id AS VARCHAR) AS ticker, event_id,
                       CASE WHEN value < 1 THEN TIMESTAMP '2001-01-01' ELSE ts END AS date,
                       value AS adj_close,
                       CAST(CASE WHEN value >= 30 THEN 0 WHEN value >= 5 THEN 0.5 END AS DOUBLE) AS dividends
                FROM events WHERE event_type <> 'error' AND value < 50),
            counted AS (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY event_id) AS n
                        FROM entered)
            SELECT ticker, date, adj_close, dividends, year(date) AS year, month(date) AS month
            FROM counted WHERE n = 1""",
        "clean_tape": "SELECT * FROM tape",
        "curated_tape": "SELECT * FROM tape",
        "incremental_refresh": "SELECT * FROM tape",
        "company_rows": "SELECT * FROM comp",
        "recent_rows": "SELECT * FROM comp WHERE date BETWEEN TIMESTAMP '2000-08-01' AND TIMESTAMP '2001-08-01'",
        "normalise_utc": """
            SELECT event_id, ts AS from_utc, ts - INTERVAL '5 hours 30 minutes' AS from_offset
            FROM events""",
        "dedupe_tape": "SELECT ticker, date, adj_close, dividends FROM tape",
        "latest_company": "SELECT * FROM newest",
        "current_company": "SELECT n.* FROM newest n JOIN now_in ON ticker = symbol",
        "membership_intervals": "SELECT * FROM intervals",
        "extended_intervals": "SELECT * FROM intervals",
        "members_as_of": """
            SELECT symbol AS ticker, security AS name, gics_sector AS sector, gics_sub_industry AS industry
            FROM held WHERE updated_at = (
                SELECT max(updated_at) FROM snapshots WHERE updated_at <= TIMESTAMP '2000-03-15')""",
        "companies_as_of": """
            SELECT symbol AS ticker, arg_max_null(security, updated_at) AS name,
                   arg_max_null(gics_sector, updated_at) AS sector,
                   arg_max_null(gics_sub_industry, updated_at) AS industry
            FROM held WHERE updated_at <= TIMESTAMP '2000-03-15' GROUP BY symbol""",
        "snapshot_diff_as_of": """
            , two AS (SELECT DISTINCT run FROM held WHERE updated_at <= TIMESTAMP '2000-03-15'
                      ORDER BY run DESC LIMIT 2)
            SELECT symbol, CASE WHEN min(run) = (SELECT max(run) FROM two) THEN 'added'
                                WHEN max(run) < (SELECT max(run) FROM two) THEN 'removed'
                                ELSE 'retained' END AS status
            FROM held WHERE run IN (SELECT run FROM two) GROUP BY symbol""",
        "snapshot_times": "SELECT * FROM times",
        "latest_members": "SELECT * FROM now_in",
        "previous_members": "SELECT * FROM before_in",
        "new_members": "SELECT * FROM fresh",
        "snapshot_diff": """
            SELECT coalesce(n.symbol, b.symbol) AS symbol,
                   CASE WHEN b.symbol IS NULL THEN 'added' WHEN n.symbol IS NULL THEN 'removed'
                        ELSE 'retained' END AS status
            FROM now_in n FULL OUTER JOIN before_in b ON n.symbol = b.symbol""",
        "universe": "SELECT * FROM members",
        "wide_to_long": """
            SELECT l_shipdate AS date, l_returnflag || l_linestatus AS ticker,
                   max(l_extendedprice) AS high,
                   max(CASE WHEN l_discount >= 0.09 THEN l_discount END) AS dividends
            FROM lineitem GROUP BY 1, 2""",
        "fetch_plan": """
            SELECT symbol, 'daily' AS mode, TIMESTAMP '2001-07-31' AS start_date,
                   TIMESTAMP '2001-08-01' AS end_date, CAST(-1 AS BIGINT) AS batch,
                   '2001-08-01-00-00-00-daily.csv' AS output_key
            FROM before_in
            UNION ALL
            SELECT symbol, 'historical', TIMESTAMP '1900-01-01', TIMESTAMP '2001-08-01',
                   CAST(position // 100 * 100 AS BIGINT),
                   '2001-08-01-00-00-00-historical-batch-' || (position // 100 * 100) || '.csv'
            FROM (SELECT symbol, row_number() OVER (ORDER BY substr(md5(symbol), 1, 3), symbol) - 1
                             AS position FROM fresh)""",
        "annual_dividends": f"""
            SELECT ticker, year, {six('annual_dividend')} AS annual_dividend, dividend_frequency
            FROM annual""",
        "dividend_change": f"""
            SELECT ticker, year, {six('annual_dividend')} AS annual_dividend, dividend_frequency,
                   {six('dividend_increase')} AS dividend_increase, flag FROM changes""",
        "growth_streak": f"""
            SELECT ticker, year, {six('annual_dividend')} AS annual_dividend, dividend_frequency,
                   {six('dividend_increase')} AS dividend_increase, flag,
                   CAST(row_number() OVER (PARTITION BY ticker ORDER BY year) - streak AS INTEGER) AS grp,
                   CAST(streak AS INTEGER) AS consecutive_growth_years
            FROM streaks""",
        "dividend_growth": f"""
            SELECT ticker, dividend_frequency, consecutive_growth_years,
                   {six('five_year_cagr')} AS five_year_cagr FROM growth""",
        "dividend_growth_calendar": f"""
            SELECT s.ticker, s.dividend_frequency, CAST(s.streak AS INTEGER) AS consecutive_growth_years,
                   {six('pow(s.annual_dividend / nullif(a.annual_dividend, 0), 0.25) - 1')}
                       AS five_year_cagr
            FROM streaks s LEFT JOIN annual a ON a.ticker = s.ticker AND a.year = 1996
            WHERE s.year = 2000 AND s.streak >= 2""",
        "dividend_cagr_calendar": f"""
            SELECT b.ticker, b.year, {six('pow(b.annual_dividend / nullif(a.annual_dividend, 0), 0.25) - 1')}
                       AS calendar_cagr
            FROM annual b LEFT JOIN annual a ON a.ticker = b.ticker AND a.year = 1996
            WHERE b.year = 2000""",
        "log_returns": f"""
            SELECT ticker, date, adj_close, {six('r')} AS log_return FROM returns
            WHERE ticker NOT IN ('0', '1')""",
        "intraday_returns": f"""
            , steps AS (
                SELECT *, lag(adj_close) OVER (PARTITION BY ticker ORDER BY date) AS previous
                FROM event_tape)
            SELECT ticker, date, adj_close,
                   CASE WHEN previous <> 0 AND adj_close / previous > 0
                        THEN {six('ln(adj_close / previous)')} END AS log_return
            FROM steps WHERE date BETWEEN TIMESTAMP '2023-02-01' AND TIMESTAMP '2024-02-01'""",
        "market_returns": f"SELECT date, {six('m')} AS market_return FROM market",
        "beta": f"SELECT ticker, {six('beta')} AS beta FROM betas",
        "stored_beta": f"SELECT ticker, {six('beta')} AS beta FROM betas",
        "beta_paired": f"SELECT ticker, {six('paired')} AS beta FROM betas",
        "beta_monthly": f"""
            , ends AS (
                SELECT ticker, year * 12 + month AS month_index, arg_max_null(adj_close, date) AS price
                FROM tape WHERE date BETWEEN TIMESTAMP '1996-08-02' AND TIMESTAMP '2001-08-01' GROUP BY 1, 2),
            steps AS (
                SELECT ticker, month_index,
                       ln(price / lag(price) OVER (PARTITION BY ticker ORDER BY month_index)) AS r
                FROM ends)
            SELECT c.ticker, {six('covar_pop(c.r, i.r) / nullif(var_pop(i.r), 0)')} AS beta_monthly
            FROM steps c JOIN steps i ON c.month_index = i.month_index AND i.ticker = '0'
            WHERE c.ticker NOT IN ('0', '1') GROUP BY c.ticker""",
        "latest_price": "SELECT * FROM latest",
        "price_history": """
            SELECT ticker, date, adj_close FROM comp WHERE date BETWEEN TIMESTAMP '2001-07-02' AND TIMESTAMP '2001-08-01'""",
        "dividend_history": """
            SELECT ticker, date, dividends FROM comp
            WHERE date BETWEEN TIMESTAMP '2000-08-01' AND TIMESTAMP '2001-08-01' AND dividends > 0""",
        "benchmark_rates": f"SELECT ticker, {six('rate')} AS rate FROM rates",
        "index_rate_calendar": f"""
            SELECT ticker, {six(index_growth)} AS rate
            FROM tape WHERE ticker = '0' AND date BETWEEN TIMESTAMP '1996-08-02' AND TIMESTAMP '2001-08-01' GROUP BY ticker""",
        "company_report": f"""
            SELECT * REPLACE ({six('beta')} AS beta, {six('five_year_cagr')} AS five_year_cagr)
            FROM report""",
        "company_figures": f"""
            SELECT ticker, name, sector, industry, consecutive_growth_years, dividend_frequency,
                   {six('beta')} AS beta, {six('five_year_cagr')} AS five_year_cagr,
                   last_dividend, last_price
            FROM report""",
        "gordon_value": f"""
            , priced AS (
                SELECT ticker, five_year_cagr AS g,
                       (SELECT rate FROM rates WHERE ticker = '1')
                       + beta * ((SELECT rate FROM rates WHERE ticker = '0')
                                 - (SELECT rate FROM rates WHERE ticker = '1')) AS k,
                       last_dividend * dividend_frequency * (1 + five_year_cagr) AS d
                FROM report)
            SELECT ticker, {six('k')} AS required_return, {six('d')} AS next_dividend,
                   CASE WHEN k > g THEN {six('d / (k - g)')} END AS fair_price
            FROM priced""",
        "coverage_gaps": """
            , days AS (SELECT DISTINCT ticker, CAST(date AS DATE) AS day FROM comp),
            steps AS (
                SELECT ticker, day, lag(day) OVER (PARTITION BY ticker ORDER BY day) AS previous
                FROM days),
            missing AS (
                SELECT ticker, CAST(unnest(generate_series(
                           CAST(previous + 1 AS TIMESTAMP), CAST(day - 1 AS TIMESTAMP),
                           INTERVAL 1 DAY)) AS DATE) AS missing_day
                FROM steps WHERE day - previous > 1)
            SELECT ticker, missing_day FROM missing WHERE isodow(missing_day) < 6""",
        "coverage_gaps_as_of": """
            , days AS (
                SELECT ticker, CAST(date AS DATE) AS day FROM comp
                WHERE date <= TIMESTAMP '2001-08-01'
                UNION SELECT ticker, DATE '2001-08-02' FROM comp
                WHERE date <= TIMESTAMP '2001-08-01'),
            steps AS (
                SELECT ticker, day, lag(day) OVER (PARTITION BY ticker ORDER BY day) AS previous
                FROM days),
            missing AS (
                SELECT ticker, CAST(unnest(generate_series(
                           CAST(previous + 1 AS TIMESTAMP), CAST(day - 1 AS TIMESTAMP),
                           INTERVAL 1 DAY)) AS DATE) AS missing_day
                FROM steps WHERE day - previous > 1)
            SELECT ticker, missing_day FROM missing WHERE isodow(missing_day) < 6""",
        "stream_annual": """
            SELECT ticker, year, round(sum(dividends), 6) + 0.0 AS annual_dividend,
                   count(CASE WHEN dividends > 0 THEN 1 END) AS dividend_frequency
            FROM comp GROUP BY ticker, year""",
    }
    built = {name: _query(select) for name, select in selects.items()}
    built["member_report"] = _query(
        f"""
        SELECT g.ticker, m.security AS name, m.gics_sector AS sector, m.gics_sub_industry AS industry,
               g.consecutive_growth_years, g.dividend_frequency, {six('b.beta')} AS beta,
               {six('g.five_year_cagr')} AS five_year_cagr, l.last_dividend, l.last_price
        FROM growth g JOIN betas b USING (ticker) JOIN latest l USING (ticker)
        JOIN histories h USING (ticker)
        JOIN held m ON m.symbol = g.ticker AND m.updated_at = (SELECT max(updated_at) FROM snapshots
            WHERE updated_at <= TIMESTAMP '2001-07-18')""",
        min_streak=1,
    )
    built["dropped_companies"] = _query(
        """
        , trading AS (SELECT DISTINCT date FROM tape
                      WHERE ticker = '0' AND date BETWEEN TIMESTAMP '1996-08-02' AND TIMESTAMP '2001-08-01'),
        seen AS (
            SELECT c.ticker, max(t.date) AS market_day,
                   bool_or(c.date BETWEEN TIMESTAMP '2001-07-02' AND TIMESTAMP '2001-08-01') AS recent
            FROM comp c LEFT JOIN trading t ON c.date = t.date
            WHERE c.date BETWEEN TIMESTAMP '1996-08-02' AND TIMESTAMP '2001-08-01' GROUP BY c.ticker),
        judged AS (
            SELECT g.ticker, CASE WHEN market_day IS NULL THEN 'no market day'
                                  WHEN a.s_suppkey IS NULL THEN 'no company'
                                  WHEN NOT coalesce(recent, FALSE) THEN 'no recent price' END AS reason
            FROM growth g LEFT JOIN seen USING (ticker)
            LEFT JOIN supplier a ON CAST(a.s_suppkey AS VARCHAR) = g.ticker)
        SELECT ticker, reason FROM judged WHERE reason IS NOT NULL""",
        min_streak=1,
    )
    return built
