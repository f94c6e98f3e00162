"""DuckDB SQL for every registered query (the correctness oracle).

Plain SQL over the driver's base tables (customer, events, lineitem, ...); it shares
the fixtures' fixed values and the schemas with the Spark code.  Fixture tables are CTEs defined once
here and pulled into each statement with their dependencies.
"""

from __future__ import annotations

from indexforge.constants import DEFAULT_MISSING_BATCH, DEFAULT_TOP_N, EQUAL_WEIGHTED, INDEX_TYPES, MARKET_CAP_WEIGHTED
from indexforge.plans import catalog as q
from indexforge.schemas import TABLES, TICKER_DETAILS, not_null_columns
from indexforge.sources import fixtures as fx

_DUCK = {"string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "double": "DOUBLE",
         "int": "INTEGER", "bigint": "BIGINT", "timestamp_ntz": "TIMESTAMP"}


def _lit_date(d) -> str:
    return f"DATE '{d}'"


def _lit_ts(ts) -> str:
    return f"TIMESTAMP '{ts}'"


def _typed_select(schema, values: dict) -> str:
    out = []
    for f in schema.fields:
        t = _DUCK[f.dataType.simpleString()]
        out.append(f"CAST({values.get(f.name, 'NULL')} AS {t}) AS {f.name}")
    return ", ".join(out)


def pct(level: str, part: str, order: str, fill_zero: bool = True) -> str:
    """pandas pct_change (pad) * 100: NaN is missing, 0/0 and leading values
    filled with 0 (or null), x/0 signed infinity, NaN outcomes filled."""
    w = f"PARTITION BY {part} ORDER BY {order}"
    lv = f"CASE WHEN isnan({level}) THEN NULL ELSE {level} END"
    filled = f"last_value({lv} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    prev = f"last_value({lv} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    miss = "CAST(0 AS DOUBLE)" if fill_zero else "CAST(NULL AS DOUBLE)"
    ratio = f"(({filled}) / ({prev}) - 1) * 100"
    return (f"CASE WHEN ({prev}) IS NULL OR ({filled}) IS NULL THEN {miss} "
            f"WHEN ({prev}) = 0 AND ({filled}) = 0 THEN {miss} "
            f"WHEN ({prev}) = 0 AND (({filled}) > 0) <> (CAST(({prev}) AS VARCHAR) = '-0.0') "
            f"THEN CAST('inf' AS DOUBLE) "
            f"WHEN ({prev}) = 0 THEN CAST('-inf' AS DOUBLE) "
            f"WHEN isnan({ratio}) THEN {miss} "
            f"ELSE {ratio} END")


def build(bars: str, inst: str, n: int, where: str = "", types=INDEX_TYPES) -> str:
    """Top n by market cap per date, weights for each index type."""
    type_rows = ", ".join(f"('{t}')" for t in types)
    return f"""
    SELECT date, ticker, close_price,
           CASE index_type WHEN '{EQUAL_WEIGHTED}' THEN w_ew ELSE w_mcw END AS weight,
           market_cap, index_type
    FROM (
      SELECT date, ticker, close_price, market_cap,
             CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY date) AS w_ew,
             market_cap / sum(market_cap) OVER (PARTITION BY date) AS w_mcw
      FROM (
        SELECT b.date, b.ticker, b.timestamp, b.close AS close_price, i.market_cap,
               row_number() OVER (PARTITION BY b.date ORDER BY i.market_cap DESC, b.ticker ASC,
                                  b.timestamp ASC, b.close ASC) AS rn
        FROM {bars} b JOIN {inst} i ON b.ticker = i.ticker
        WHERE i.market_cap IS NOT NULL {where}
      ) ranked WHERE rn <= {n}
    ) top CROSS JOIN (VALUES {type_rows}) types(index_type)"""


def osum(x: str) -> str:
    """Sum that does not depend on the order of its terms."""
    return f"CAST(sum(CAST({x} AS DECIMAL(38,15))) AS DOUBLE)"


def latest(src: str, keys: str, extra_where: str = "") -> str:
    return f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY update_time DESC) AS rn
      FROM {src} {extra_where}) WHERE rn = 1"""


def members_lagged(members: str) -> str:
    return f"""
    SELECT date, symbols,
           lag(date) OVER (PARTITION BY index_type ORDER BY date) AS prev_date,
           lag(symbols) OVER (PARTITION BY index_type ORDER BY date) AS prev_symbols,
           index_type
    FROM (SELECT index_type, date, string_agg(ticker, ',' ORDER BY ticker) AS symbols
          FROM {members} GROUP BY index_type, date)"""


_CHANGED = "(symbols <> prev_symbols OR prev_symbols IS NULL)"


def _between(a, b, col="date") -> str:
    return f"{col} BETWEEN {_lit_date(a)} AND {_lit_date(b)}"


# --- fixture CTEs ------------------------------------------------------------------
_details_instruments = {
    "ticker": "printf('U%06d', c_custkey)", "active": "c_custkey % 10 <> 0",
    "name": "c_name", "market": "c_mktsegment",
    "market_cap": "CASE WHEN c_acctbal > 0 THEN c_acctbal * 1e6 END"}

LANDED = f"CAST(ts AS DATE) + CAST(CASE WHEN event_id % {fx.LATE_EVERY} = 0 THEN 1 ELSE 0 END AS INTEGER)"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "fx_instruments": (f"SELECT {_typed_select(TICKER_DETAILS, _details_instruments)} FROM customer", ()),
    "fx_instruments_wide": (
        "SELECT " + _typed_select(TICKER_DETAILS, {
            "ticker": "printf('S%06d', s_suppkey)", "active": "true", "name": "s_name",
            "market_cap": "CASE WHEN s_acctbal > 0 THEN s_acctbal * 1e6 END"}) + " FROM supplier", ()),
    "fx_bars": ("""
      SELECT printf('U%06d', user_id) AS ticker, epoch_ms(CAST(date AS TIMESTAMP)) AS timestamp,
             date, open, high, low, close, CAST(n AS DOUBLE) AS volume,
             CAST(n AS INTEGER) AS transactions, vwap AS volume_weighted_avg,
             false AS is_otc, true AS is_adjusted
      FROM (SELECT user_id, CAST(ts AS DATE) AS date,
                   arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
                   arg_max(value, (ts, event_id)) AS close, count(*) AS n, avg(value) AS vwap
            FROM events GROUP BY user_id, CAST(ts AS DATE))""", ()),
    "fx_bars_wide": ("""
      SELECT printf('S%06d', l_suppkey) AS ticker, epoch_ms(CAST(date AS TIMESTAMP)) AS timestamp,
             date, open, high, low, close, qty AS volume, CAST(n AS INTEGER) AS transactions,
             amount / qty AS volume_weighted_avg, false AS is_otc, true AS is_adjusted
      FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date,
                   arg_min(l_extendedprice / l_quantity,
                           (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS open,
                   max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
                   arg_max(l_extendedprice / l_quantity,
                           (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS close,
                   sum(l_quantity) AS qty, count(*) AS n, sum(l_extendedprice) AS amount
            FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE))""", ()),
    "fx_run1": (build("fx_bars", "fx_instruments", fx.RUN1_TOP_N), ("fx_bars", "fx_instruments")),
    "fx_run2": (build("fx_bars", "fx_instruments", fx.RUN2_TOP_N, "AND dayofmonth(b.date) % 2 = 0"),
                ("fx_bars", "fx_instruments")),
    "fx_composition": (f"""
      SELECT *, {_lit_ts(fx.RUN1_TS)} AS update_time FROM fx_run1
      UNION ALL SELECT *, {_lit_ts(fx.RUN2_TS)} AS update_time FROM fx_run2
      UNION ALL SELECT *, {_lit_ts(fx.RUN3_TS)} AS update_time FROM fx_run1 WHERE dayofmonth(date) % 4 = 0""",
                       ("fx_run1", "fx_run2")),
    "fx_latest": (latest("fx_composition", "index_type, date, ticker"), ("fx_composition",)),
    "fx_levels": (f"""
      SELECT l.index_type, b.date, {osum('l.weight * b.close')} AS index_price
      FROM fx_bars b JOIN fx_latest l ON b.ticker = l.ticker AND b.date = l.date
      GROUP BY l.index_type, b.date""", ("fx_bars", "fx_latest")),
    "fx_performance": (f"""
      SELECT date, index_price, {pct('index_price', 'update_time, index_type', 'date')} AS daily_return,
             index_type, update_time
      FROM fx_levels JOIN (VALUES {", ".join(f"({_lit_ts(t)}, {_lit_date(s)}, {_lit_date(e)})" for t, s, e in fx.PERF_RUNS)})
           runs(update_time, rs, re) ON fx_levels.date BETWEEN runs.rs AND runs.re""", ("fx_levels",)),
    "fx_lagged": (members_lagged("fx_latest"), ("fx_latest",)),
    "fx_changes": (f"SELECT *, {_lit_ts(fx.CHANGES_TS)} AS update_time FROM fx_lagged WHERE {_CHANGED}",
                   ("fx_lagged",)),
    "fx_ticks": (f"""
      SELECT {LANDED} AS date, CAST(ts AS DATE) AS own_date, event_id,
             CASE WHEN event_type <> 'error' THEN printf('U%06d', user_id) END AS ticker,
             epoch_us(ts) // 1000 AS epoch_ms, value AS o, value AS h, value AS l, value AS c,
             CAST(1 AS DOUBLE) AS v, CAST(1 AS INTEGER) AS n, value AS vw,
             CASE WHEN event_id % 2 = 0 THEN true END AS otc
      FROM events""", ()),
    "fx_tick_bars": ("""
      SELECT ticker, epoch_ms AS timestamp, date, o AS open, h AS high, l AS low, c AS close,
             v AS volume, n AS transactions, vw AS volume_weighted_avg,
             coalesce(otc, false) AS is_otc, true AS is_adjusted
      FROM fx_ticks""", ("fx_ticks",)),
    "fx_again_bars": (f"""
      SELECT ticker, epoch_ms AS timestamp, date + 2 AS date, o * 2 AS open, h * 2 AS high, l * 2 AS low,
             c * 2 AS close, v AS volume, n AS transactions, vw * 2 AS volume_weighted_avg,
             false AS is_otc, true AS is_adjusted
      FROM fx_ticks WHERE event_id % {fx.REDELIVERED_EVERY} = 0""", ("fx_ticks",)),
}


def sql(select: str, *deps: str) -> str:
    """Prefix ``select`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)
    for d in deps:
        visit(d)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + select


COMP_COLS = "date, ticker, close_price, weight, market_cap, index_type"
PRICE_COLS = ("ticker, timestamp, date, open, high, low, close, volume, transactions, "
              "volume_weighted_avg, is_otc, is_adjusted")
DETAIL_COLS = ", ".join(f.name for f in TICKER_DETAILS.fields)
R0, R1 = q.REPORT_START, q.REPORT_END


def _details_loads() -> str:
    second = _typed_select(TICKER_DETAILS, {
        "ticker": "printf('U%06d', c_custkey)", "active": "true", "name": "upper(c_name)",
        "market_cap": "CASE WHEN c_acctbal > 0 THEN c_acctbal * 2e6 END"})
    return (f"(SELECT {DETAIL_COLS}, 1 AS _seq FROM fx_instruments UNION ALL "
            f"SELECT {second}, 2 AS _seq FROM customer WHERE c_mktsegment = '{q.REDELIVERED_SEGMENT}')")


def _details_partial() -> str:
    loads = _details_loads()
    cols = [f.name for f in TICKER_DETAILS.fields]
    pick = ", ".join(("l." if c == "market_cap" else "f.") + c + f" AS {c}" for c in cols)
    return f"""
    SELECT {pick} FROM
      (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY _seq ASC) rn FROM {loads}) WHERE rn = 1) f
    JOIN
      (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY _seq DESC) rn FROM {loads}) WHERE rn = 1) l
    ON f.ticker = l.ticker"""


_UPS_ORDER = "l_shipdate {d}, l_partkey {d}, l_suppkey {d}, l_extendedprice {d}"
_UPS_COLS = ("l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, "
             "l_returnflag, l_quantity")


def _upsert_rank(direction: str) -> str:
    return (f"(SELECT {_UPS_COLS}, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
            f"ORDER BY {_UPS_ORDER.format(d=direction)}) AS rn FROM lineitem)")


def _audit_sql(srcs: dict | None = None) -> str:
    srcs = srcs or {"ticker_details": "fx_instruments", "stock_prices": "fx_bars",
            "index_composition": "fx_composition", "index_performance": "fx_performance",
            "index_composition_changes": "fx_changes"}
    parts = []
    for name, src in srcs.items():
        schema, key = TABLES[name]
        key = list(key)
        parts.append(
            f"SELECT '{name}' AS table_name, 'duplicate_key' AS rule, '{','.join(key)}' AS column_name, "
            f"CAST(coalesce(sum(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT) AS violations "
            f"FROM (SELECT count(*) AS n FROM {src} GROUP BY {', '.join(key)})")
        for c in dict.fromkeys(key + not_null_columns(schema)):
            parts.append(f"SELECT '{name}', 'null_value', '{c}', "
                         f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) FROM {src}")
    return "\nUNION ALL\n".join(parts)


def _snapshot(where: str) -> str:
    return latest(f"(SELECT * FROM fx_composition WHERE {where})", "index_type, date, ticker")


def _legacy_collapse(src: str) -> str:
    return (f"SELECT index_type, date, ticker, close_price, weight, market_cap, "
            f"max(update_time) AS latest_update_time FROM {src} "
            f"GROUP BY index_type, date, ticker, close_price, weight, market_cap")


def _perf_collapse(src: str) -> str:
    return (f"SELECT index_type, date, index_price, arg_max(daily_return, update_time) AS daily_return, "
            f"max(update_time) AS latest_update_time FROM {src} GROUP BY index_type, date, index_price")


def _tracked(where: str = "") -> str:
    src = f"(SELECT * FROM fx_levels {where})"
    return f"SELECT date, index_price, {pct('index_price', 'index_type', 'date')} AS daily_return, index_type FROM {src}"


def _history(a, b) -> str:
    lat = latest(f"(SELECT * FROM fx_performance WHERE {_between(a, b)})", "index_type, date")
    return (f"SELECT date, index_price, {pct('index_price', 'index_type', 'date')} AS daily_return, "
            f"index_type FROM ({lat})")


def _percent(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN 'nan%' ELSE printf('%.2f%%', {x}) END"


def _summary(src: str) -> str:
    return (f"SELECT index_type, sum(daily_return) AS total_return, avg(daily_return) AS mean_return, "
            f"stddev_samp(daily_return) AS volatility, count(*) AS days FROM ({src}) GROUP BY index_type")


def _current(rule: str) -> str:
    """Both loads: the newest row of a key wins, or only its prices do."""
    first = ("date", "is_otc", "is_adjusted") if rule == "partial" else ()
    cols = ", ".join(("f." if c in first else "l.") + c + f" AS {c}" for c in PRICE_COLS.split(", "))
    loads = (f"(SELECT {PRICE_COLS}, 1 AS load FROM fx_tick_bars WHERE ticker IS NOT NULL UNION ALL "
             f"SELECT {PRICE_COLS}, 2 FROM fx_again_bars WHERE ticker IS NOT NULL)")
    pick = (f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, timestamp ORDER BY load {{}}) rn "
            f"FROM {loads}) WHERE rn = 1)")
    return (f"SELECT {cols} FROM {pick.format('ASC')} f JOIN {pick.format('DESC')} l "
            f"ON f.ticker = l.ticker AND f.timestamp = l.timestamp")


def _details_json() -> str:
    vals = dict(_details_instruments)
    vals.update({
        "locale": "'us'",
        "address1": "CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey AS VARCHAR) || ' Market St' END",
        "city": "CASE WHEN c_custkey % 7 <> 0 THEN n_name END",
        "branding_icon_url": "CASE WHEN c_custkey % 5 <> 0 THEN 'icons/' || printf('U%06d', c_custkey) || '.svg' END",
        "branding_logo_url": "CASE WHEN c_custkey % 5 <> 0 THEN 'logos/' || printf('U%06d', c_custkey) || '.svg' END",
    })
    return (f"SELECT {_typed_select(TICKER_DETAILS, vals)} FROM customer "
            f"LEFT JOIN nation ON c_nationkey = n_nationkey")


def _weekday(col="date") -> str:
    return f"dayofweek({col}) BETWEEN 1 AND 5"


_MISSING = ("SELECT printf('U%06d', c_custkey) AS ticker FROM customer WHERE c_custkey % 10 <> 0 AND NOT EXISTS "
            "(SELECT 1 FROM events WHERE printf('U%06d', user_id) = printf('U%06d', c_custkey))")

ORACLE: dict[str, str] = {
    # 2.1
    "roster_scan": "SELECT printf('U%06d', c_custkey) AS ticker FROM customer "
                   "WHERE c_custkey % 10 <> 0 ORDER BY ticker",
    "details_flatten": _details_json(),
    "bars_flatten_epoch": sql(f"SELECT b.* REPLACE (CAST(epoch_ms(timestamp) AS DATE) AS date) "
                              f"FROM (SELECT {PRICE_COLS} FROM fx_tick_bars) b", "fx_tick_bars"),
    "bars_flatten_request": sql(f"SELECT {PRICE_COLS} FROM fx_tick_bars", "fx_tick_bars"),
    "scan_prices": sql("SELECT * FROM fx_bars", "fx_bars"),
    "preview_details": sql("SELECT * FROM fx_instruments ORDER BY ticker LIMIT 10", "fx_instruments"),
    "preview_prices": sql("SELECT * FROM fx_bars ORDER BY ticker, timestamp LIMIT 10", "fx_bars"),
    "adhoc_sql": sql(f"SELECT ticker, market_cap FROM fx_instruments "
                     f"WHERE market_cap >= {q.ADHOC_MIN_CAP!r} AND active = true", "fx_instruments"),
    "stored_ticker_set": sql("SELECT DISTINCT ticker FROM fx_instruments WHERE ticker IS NOT NULL",
                             "fx_instruments"),
    # 2.2
    "upsert_replace_details": sql(
        f"SELECT {DETAIL_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY _seq DESC) rn "
        f"FROM {_details_loads()}) WHERE rn = 1", "fx_instruments"),
    "upsert_partial_details": sql(_details_partial(), "fx_instruments"),
    "upsert_replace_bars": f"SELECT {_UPS_COLS} FROM {_upsert_rank('DESC')} WHERE rn = 1",
    "upsert_partial_bars": f"""
        SELECT f.l_orderkey, f.l_linenumber, f.l_shipdate, f.l_returnflag, l.l_quantity, l.l_extendedprice
        FROM (SELECT * FROM {_upsert_rank('ASC')} WHERE rn = 1) f
        JOIN (SELECT * FROM {_upsert_rank('DESC')} WHERE rn = 1) l
          ON f.l_orderkey = l.l_orderkey AND f.l_linenumber = l.l_linenumber""",
    "append_composition": sql("SELECT * FROM fx_composition", "fx_composition"),
    "append_performance": sql("SELECT * FROM fx_performance", "fx_performance"),
    "append_changes": sql("SELECT * FROM fx_changes", "fx_changes"),
    "conflict_skip": sql("SELECT * FROM fx_composition", "fx_composition"),
    "dead_letter_split": "SELECT strftime(" + LANDED + ", '%Y-%m-%d') AS date, CAST(NULL AS VARCHAR) AS ticker, "
                         "epoch_us(ts) // 1000 AS t, value AS close, 'null_ticker' AS reason "
                         "FROM events WHERE event_type = 'error'",
    "ingest_counts": "SELECT " + LANDED + " AS date, count(*) AS total, "
                     "count(*) FILTER (WHERE event_type <> 'error') AS success, "
                     "count(*) FILTER (WHERE event_type = 'error') AS rejected FROM events GROUP BY " + LANDED,
    "export_performance": sql(f"SELECT * FROM fx_performance WHERE index_type = '{EQUAL_WEIGHTED}' "
                              f"AND {_between(R0, R1)}", "fx_performance"),
    "export_composition": sql(f"SELECT {COMP_COLS} FROM ({_snapshot(f'date = {_lit_date(q.SNAPSHOT_DATE)} AND index_type = ' + chr(39) + MARKET_CAP_WEIGHTED + chr(39))})",
                              "fx_composition"),
    "export_query": sql("SELECT * FROM fx_composition", "fx_composition"),
    "table_audit": sql(_audit_sql(), "fx_instruments", "fx_bars", "fx_composition",
                       "fx_performance", "fx_changes"),
    "table_audit_violations": sql(_audit_sql({"stock_prices": "(SELECT * FROM fx_tick_bars UNION ALL "
                                              "SELECT * FROM fx_again_bars)"}), "fx_tick_bars", "fx_again_bars"),
    "append_rejects": sql(f"""
        SELECT index_type, date, ticker, close_price, CASE WHEN nth = 1 THEN '' ELSE 'repeated_key' END AS reason
        FROM (SELECT *, row_number() OVER (PARTITION BY index_type, date, ticker
                                           ORDER BY close_price, weight, market_cap) AS nth
              FROM ({build("(SELECT * FROM fx_tick_bars WHERE ticker IS NOT NULL)", "fx_instruments", DEFAULT_TOP_N)}))""",
                          "fx_tick_bars", "fx_instruments"),
    "current_prices_replace": sql(_current("replace"), "fx_tick_bars", "fx_again_bars"),
    "current_prices_partial": sql(_current("partial"), "fx_tick_bars", "fx_again_bars"),
    # 2.3
    "project_rename": sql("SELECT ticker, date, close AS close_price FROM fx_bars", "fx_bars"),
    "literal_columns": sql(f"SELECT ticker, date, '{EQUAL_WEIGHTED}' AS index_type, "
                           f"{_lit_ts(q.RUN_TS)} AS update_time FROM fx_bars", "fx_bars"),
    "filter_eligible": sql(f"SELECT b.ticker, b.date, b.close AS close_price, i.market_cap "
                           f"FROM fx_bars b JOIN fx_instruments i ON b.ticker = i.ticker "
                           f"WHERE b.date = {_lit_date(q.SNAPSHOT_DATE)} AND i.market_cap IS NOT NULL",
                           "fx_bars", "fx_instruments"),
    "filter_date_range": sql(f"SELECT * FROM fx_bars WHERE {_between(R0, R1)}", "fx_bars"),
    "default_window": sql(f"SELECT * FROM fx_bars WHERE {_between('2024-01-11', q.AS_OF)}", "fx_bars"),
    "filter_changed": sql(f"SELECT * FROM fx_lagged WHERE {_CHANGED}", "fx_lagged"),
    "instrument_subset": sql("SELECT * FROM fx_instruments WHERE ticker IN ("
                             + ", ".join(f"'{t}'" for t in q.SUBSET_TICKERS) + ")", "fx_instruments"),
    "filter_index_type": sql(f"SELECT * FROM fx_composition WHERE index_type = '{MARKET_CAP_WEIGHTED}'",
                             "fx_composition"),
    "filter_exclude_otc": sql(f"SELECT {PRICE_COLS} FROM fx_tick_bars WHERE NOT is_otc", "fx_tick_bars"),
    # 2.4
    "join_instruments_prices": sql("SELECT b.ticker, b.date, b.timestamp, b.close AS close_price, i.market_cap "
                                   "FROM fx_bars b JOIN fx_instruments i ON b.ticker = i.ticker WHERE i.active",
                                   "fx_bars", "fx_instruments"),
    "join_prices_composition": sql("SELECT b.ticker, b.date, b.close, l.index_type, l.weight "
                                   "FROM fx_bars b JOIN fx_latest l ON b.ticker = l.ticker AND b.date = l.date",
                                   "fx_bars", "fx_latest"),
    "missing_symbols": _MISSING,
    "missing_symbols_batch": _MISSING + f" ORDER BY ticker LIMIT {DEFAULT_MISSING_BATCH}",
    "previous_snapshot_lookup": sql("SELECT * FROM fx_lagged", "fx_lagged"),
    # 2.5
    "index_level": sql("SELECT * FROM fx_levels", "fx_levels"),
    "daily_membership": sql("SELECT index_type, date, string_agg(ticker, ',' ORDER BY ticker) AS symbols "
                            "FROM fx_latest GROUP BY index_type, date", "fx_latest"),
    "total_market_cap": sql("SELECT index_type, date, sum(market_cap) AS total_market_cap FROM fx_run1 "
                            "GROUP BY index_type, date", "fx_run1"),
    "constituent_count": sql("SELECT index_type, date, count(*) AS constituents FROM fx_run2 "
                             "GROUP BY index_type, date", "fx_run2"),
    "return_summary": sql(_summary(_tracked()), "fx_levels"),
    "composition_insights": sql(f"SELECT index_type, date, count(*) AS constituents, "
                                f"{osum('close_price')} / count(close_price) AS mean_close "
                                f"FROM fx_latest GROUP BY index_type, date", "fx_latest"),
    "change_event_count": sql(f"SELECT index_type, count(*) AS change_days FROM fx_lagged WHERE {_CHANGED} "
                              f"GROUP BY index_type", "fx_lagged"),
    "version_collapse_legacy": sql(_legacy_collapse("fx_composition"), "fx_composition"),
    "performance_collapse_legacy": sql(_perf_collapse("fx_performance"), "fx_performance"),
    # 2.6
    "composition_snapshot": sql(f"SELECT {COMP_COLS} FROM fx_latest", "fx_latest"),
    "performance_history": sql(_history(R0, R1), "fx_performance"),
    "daily_return": sql(f"SELECT index_type, date, index_price, "
                        f"{pct('index_price', 'index_type', 'date')} AS daily_return FROM fx_levels", "fx_levels"),
    "latest_weights": sql("SELECT * FROM fx_latest", "fx_latest"),
    "membership_lag": sql("SELECT * FROM fx_lagged", "fx_lagged"),
    # 2.7
    "top_n_by_market_cap": sql(f"SELECT date, ticker, close_price, market_cap FROM "
                               f"({build('fx_bars', 'fx_instruments', 5, types=(EQUAL_WEIGHTED,))})",
                               "fx_bars", "fx_instruments"),
    "sort_performance": sql(_tracked(f"WHERE {_between(R0, R1)}") + " ORDER BY index_type, date", "fx_levels"),
    "sort_composition": sql(f"SELECT {COMP_COLS} FROM fx_latest ORDER BY index_type, date, weight DESC, ticker",
                            "fx_latest"),
    # 2.9
    "fn_epoch_ms_to_date": "SELECT event_id, epoch_us(ts) // 1000 AS t, CAST(ts AS DATE) AS date FROM events",
    "fn_previous_trading_day": "SELECT date, date - CAST(CASE dayofweek(date) WHEN 1 THEN 3 WHEN 0 THEN 2 "
                               "ELSE 1 END AS INTEGER) AS previous_trading_day "
                               "FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)",
    "trading_calendar": sql("SELECT CAST(d AS DATE) AS date FROM (SELECT min(date) AS s, max(date) AS e "
                            "FROM fx_bars_wide) b, LATERAL (SELECT unnest(generate_series(CAST(b.s AS TIMESTAMP), "
                            "CAST(b.e AS TIMESTAMP), INTERVAL 1 DAY)) AS d) g "
                            "WHERE dayofweek(CAST(d AS DATE)) BETWEEN 1 AND 5", "fx_bars_wide"),
    "fn_format_date": sql("SELECT ticker, date, strftime(date, '%Y-%m-%d') AS date_text, date AS parsed "
                          "FROM fx_bars", "fx_bars"),
    "fn_slug": sql("SELECT DISTINCT index_type, replace(lower(index_type), ' ', '_') AS slug FROM fx_composition",
                   "fx_composition"),
    "fn_default": "SELECT event_id, event_id % 2 = 0 AS is_otc FROM events",
    "fn_percent_text": sql(f"SELECT index_type, {_percent('total_return')} AS total_return, "
                           f"{_percent('mean_return')} AS mean_return, {_percent('volatility')} AS volatility "
                           f"FROM ({_summary(_tracked())})", "fx_levels"),
    "fn_dollar_text": sql("SELECT ticker, CASE WHEN market_cap IS NULL THEN '$nan' "
                          "ELSE printf('$%.2f', market_cap) END AS market_cap FROM fx_instruments", "fx_instruments"),
    "fn_json_encode": sql("SELECT ticker, timestamp, CAST(to_json(struct_pack(ticker := ticker, "
                          "\"timestamp\" := timestamp, transactions := transactions)) AS VARCHAR) AS json "
                          "FROM fx_bars", "fx_bars"),
    "fn_weighted_price": sql("SELECT index_type, date, ticker, update_time, weight * close_price AS weighted_price "
                             "FROM fx_composition", "fx_composition"),
    # 2.10
    "index_equal_weighted": sql(build("fx_bars", "fx_instruments", 5, types=(EQUAL_WEIGHTED,)),
                                "fx_bars", "fx_instruments"),
    "index_market_cap_weighted": sql(build("fx_bars", "fx_instruments", 5, types=(MARKET_CAP_WEIGHTED,)),
                                     "fx_bars", "fx_instruments"),
    "index_build_range": sql(build("fx_bars_wide", "fx_instruments_wide", 100,
                                   f"AND {_between(q.WIDE_START, q.WIDE_END, 'b.date')} AND {_weekday('b.date')}"),
                             "fx_bars_wide", "fx_instruments_wide"),
    "track_index_performance": sql(_tracked(f"WHERE {_between(R0, R1)}"), "fx_levels"),
    "detect_index_changes": sql(f"SELECT * FROM fx_lagged WHERE {_CHANGED} AND {_between(R0, R1)}", "fx_lagged"),
    "composition_get_or_build": sql(f"""
        SELECT {COMP_COLS} FROM ({_snapshot(f"date <= {_lit_date(q.STORED_UNTIL)}")})
        UNION ALL
        SELECT {COMP_COLS} FROM ({build('fx_bars', 'fx_instruments', 5)}) bt
        WHERE NOT EXISTS (SELECT 1 FROM fx_composition s WHERE s.date <= {_lit_date(q.STORED_UNTIL)}
                          AND s.index_type = bt.index_type AND s.date = bt.date)""",
                                    "fx_composition", "fx_bars", "fx_instruments"),
    "performance_view": sql(f"SELECT strftime(date, '%Y-%m-%d') AS date, index_price, daily_return, index_type "
                            f"FROM ({_history(R0, R1)})", "fx_performance"),
    "composition_view": sql(f"SELECT ticker, weight, market_cap, close_price, index_type, date FROM "
                            f"({_snapshot(f'date = {_lit_date(q.SNAPSHOT_DATE)}')})", "fx_composition"),
    "ingest_daily": sql(_current("partial"), "fx_tick_bars", "fx_again_bars"),
    "index_changes_legacy": sql(
        f"SELECT * FROM ({members_lagged('(' + _legacy_collapse('fx_composition') + ')')}) "
        f"WHERE {_CHANGED} AND {_between(R0, R1)}", "fx_composition"),
    "index_level_legacy": sql(
        f"SELECT date, index_price, {pct('index_price', 'index_type', 'date')} AS daily_return, index_type FROM "
        f"(SELECT c.index_type, b.date, {osum('c.weight * b.close')} AS index_price FROM fx_bars b JOIN "
        f"({_legacy_collapse('(SELECT * FROM fx_composition WHERE ' + _between(R0, R1) + ')')}) c "
        f"ON b.ticker = c.ticker AND b.date = c.date WHERE {_between(R0, R1, 'b.date')} "
        f"GROUP BY c.index_type, b.date)", "fx_bars", "fx_composition"),
    "performance_history_legacy": sql(
        f"SELECT date, index_price, {pct('index_price', 'index_type', 'date, index_price', fill_zero=False)} "
        f"AS daily_return, latest_update_time, index_type FROM "
        f"({_perf_collapse('(SELECT * FROM fx_performance WHERE ' + _between(R0, R1) + ')')})", "fx_performance"),
    "composition_snapshot_legacy": sql(
        _legacy_collapse(f"(SELECT * FROM fx_composition WHERE date = {_lit_date(q.SNAPSHOT_DATE)})"),
        "fx_composition"),
    # 2.11
    "ingest_stream": sql(_current("partial"), "fx_tick_bars", "fx_again_bars"),
}
