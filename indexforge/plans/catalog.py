"""One query per operator of the inventory, each over the whole test tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame.  Queries that
exercise a sink write into a fresh folder under the session's checkpoint root
and return what they read back.  ``indexforge.plans.oracle`` holds the DuckDB
SQL that must give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from indexforge.constants import (
    DEFAULT_MISSING_BATCH, DEFAULT_TOP_N, EQUAL_WEIGHTED, INDEX_TYPES, MARKET_CAP_WEIGHTED, SERVICE_TOP_N,
)
from indexforge.functions import calendar as cal
from indexforge.functions import scalar as fn
from indexforge.operators import changes as chg
from indexforge.operators import construct as con
from indexforge.operators import performance as perf
from indexforge.operators import versions as ver
from indexforge.operators.audit import table_audit as _table_audit
from indexforge.operators.insights import composition_insights as _insights
from indexforge.operators.upsert import upsert_partial, upsert_replace
from indexforge.plans import views
from indexforge.plans.ingest import (
    current_prices, ingest_counts as _ingest_counts, ingest_daily as _ingest_daily, read_current,
    read_price_log,
)
from indexforge.schemas import (
    INDEX_COMPOSITION, INDEX_PERFORMANCE, STOCK_PRICES, TICKER_DETAILS,
)
from indexforge.session import scratch_path
from indexforge.sinks import export as exp
from indexforge.sinks.dead_letters import read_dead_letters
from indexforge.sinks.versioned import (
    append_changes, append_composition, append_performance, stamp,
)
from indexforge.sources import fixtures as fx
from indexforge.sources import landing
from indexforge.sources.tables import adhoc_sql as _adhoc_sql
from indexforge.sources.tables import preview, scan_table
from indexforge.sources.tables import stored_ticker_set as _stored_ticker_set
from indexforge.streaming.ingest_stream import run_ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# --- fixed parameters of the registered queries -------------------------------
AS_OF = "2024-02-10"                  # its window begins inside the data
REPORT_START, REPORT_END = "2024-01-05", "2024-01-25"
SNAPSHOT_DATE = "2024-01-16"
STORED_UNTIL = "2024-01-15"           # get-or-build: stored composition up to here
WIDE_START, WIDE_END = "1995-01-01", "2001-12-31"
SUBSET_TICKERS = ("U000001", "U000002", "U000003", "U000004", "U000005")
ADHOC_MIN_CAP = 5e9
RUN_TS = "2024-03-01 00:00:00"
SECOND_TS = "2024-03-02 00:00:00"     # the load of the re-delivered ticks
REDELIVERED_SEGMENT = "BUILDING"      # instruments re-delivered in a second load
# -------------------------------------------------------------------------------


def query(name: str):
    def deco(f: Query) -> Query:
        QUERIES[name] = f
        return f
    return deco


def _landed_payloads(spark, sf_dir) -> str:
    root = scratch_path(spark, "landing")
    fx.land_bar_payloads(fx.ticks(spark, sf_dir), root)
    return root


def _price_columns(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in STOCK_PRICES.fields])


# 2.1 sources and scans ---------------------------------------------------------
@query("roster_scan")
def roster_scan(spark, sf_dir):
    path = scratch_path(spark, "roster")
    fx.land_roster(spark, sf_dir, path)
    return landing.roster_scan(spark, path)


@query("details_flatten")
def details_flatten(spark, sf_dir):
    path = scratch_path(spark, "details")
    fx.land_detail_payloads(spark, sf_dir, path)
    return landing.read_detail_payloads(spark, path)


@query("bars_flatten_epoch")
def bars_flatten_epoch(spark, sf_dir):
    return _price_columns(landing.read_bar_payloads(spark, _landed_payloads(spark, sf_dir),
                                                    date_rule="epoch"))


@query("bars_flatten_request")
def bars_flatten_request(spark, sf_dir):
    return _price_columns(landing.read_bar_payloads(spark, _landed_payloads(spark, sf_dir),
                                                    date_rule="request"))


@query("scan_prices")
def scan_prices(spark, sf_dir):
    path = scratch_path(spark, "stock_prices")
    fx.bars(spark, sf_dir).write.partitionBy("date").parquet(path)
    return scan_table(spark, path, "stock_prices").select(*[f.name for f in STOCK_PRICES.fields])


@query("preview_details")
def preview_details(spark, sf_dir):
    return preview(fx.instruments(spark, sf_dir), "ticker")


@query("preview_prices")
def preview_prices(spark, sf_dir):
    return preview(fx.bars(spark, sf_dir), ["ticker", "timestamp"])


@query("adhoc_sql")
def adhoc_sql(spark, sf_dir):
    return _adhoc_sql(
        spark,
        "SELECT ticker, market_cap FROM {details} "
        "WHERE market_cap >= :min_cap AND active = :active",
        args={"min_cap": ADHOC_MIN_CAP, "active": True},
        details=fx.instruments(spark, sf_dir))


@query("stored_ticker_set")
def stored_ticker_set(spark, sf_dir):
    return _stored_ticker_set(fx.instruments(spark, sf_dir))


# 2.2 sinks and table maintenance -------------------------------------------------
def _details_loads(spark, sf_dir):
    """Load 1: every instrument.  Load 2: the re-delivered segment with a new cap,
    an upper-case name and no market (a whole-row replace must null it)."""
    first = fx.instruments(spark, sf_dir)
    c = fx.table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == REDELIVERED_SEGMENT)
    second = fx.as_details(c, {
        "ticker": fx.ticker_of("U", "c_custkey"),
        "active": F.lit(True),
        "name": F.upper("c_name"),
        "market_cap": F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * F.lit(2e6)),
    })
    return first.withColumn("_seq", F.lit(1)).unionByName(second.withColumn("_seq", F.lit(2)))


@query("upsert_replace_details")
def upsert_replace_details(spark, sf_dir):
    cols = [f.name for f in TICKER_DETAILS.fields]
    return upsert_replace(_details_loads(spark, sf_dir), ["ticker"], "_seq", cols).select(*cols)


@query("upsert_partial_details")
def upsert_partial_details(spark, sf_dir):
    cols = [f.name for f in TICKER_DETAILS.fields]
    kept = [c for c in cols if c not in ("ticker", "market_cap")]
    return upsert_partial(_details_loads(spark, sf_dir), ["ticker"], "_seq", kept,
                          ["market_cap"]).select(*cols)


@query("upsert_replace_bars")
def upsert_replace_bars(spark, sf_dir):
    return upsert_replace(fx.upserts(spark, sf_dir), fx.UPSERT_KEY, fx.UPSERT_ORDER)


@query("upsert_partial_bars")
def upsert_partial_bars(spark, sf_dir):
    return upsert_partial(fx.upserts(spark, sf_dir), fx.UPSERT_KEY, fx.UPSERT_ORDER,
                          fx.UPSERT_KEPT, fx.UPSERT_UPDATED)


@query("append_composition")
def append_composition_q(spark, sf_dir):
    path = scratch_path(spark, "index_composition")
    for ts, run in fx.composition_runs(spark, sf_dir):
        append_composition(run, path, ts)
    return scan_table(spark, path, "index_composition").select(
        *[f.name for f in INDEX_COMPOSITION.fields])


@query("append_performance")
def append_performance_q(spark, sf_dir):
    path = scratch_path(spark, "index_performance")
    p = fx.performance(spark, sf_dir)
    for ts, _, _ in fx.PERF_RUNS:
        run = p.filter(F.col("update_time") == F.lit(ts).cast("timestamp_ntz")).drop("update_time")
        append_performance(run, path, ts)
    return scan_table(spark, path, "index_performance").select(
        *[f.name for f in INDEX_PERFORMANCE.fields])


@query("append_changes")
def append_changes_q(spark, sf_dir):
    path = scratch_path(spark, "index_composition_changes")
    append_changes(chg.detect_index_changes(fx.composition(spark, sf_dir)), path, fx.CHANGES_TS)
    return scan_table(spark, path, "index_composition_changes").select(
        "date", "symbols", "prev_date", "prev_symbols", "index_type", "update_time")


@query("conflict_skip")
def conflict_skip_q(spark, sf_dir):
    path = scratch_path(spark, "index_composition")
    runs = fx.composition_runs(spark, sf_dir)
    for ts, run in runs:
        append_composition(run, path, ts)
    # replay run 1 with its own stamp: every key conflicts, nothing is added
    counts = append_composition(runs[0][1], path, runs[0][0])
    if counts["written"] or counts["conflicts"] != counts["built"]:
        raise AssertionError(counts)
    return scan_table(spark, path, "index_composition").select(
        *[f.name for f in INDEX_COMPOSITION.fields])


@query("append_rejects")
def append_rejects(spark, sf_dir):
    """One bar per tick: a ticker with several bars fills several slots of a day's top N; the
    key keeps one row, the others go to the rejects of the run, none is lost."""
    path = scratch_path(spark, "index_composition")
    bars = _tick_bars(spark, sf_dir).filter("ticker IS NOT NULL")
    run = con.build_index(bars, fx.instruments(spark, sf_dir), DEFAULT_TOP_N)
    append_composition(run, path, fx.RUN1_TS)
    kept = scan_table(spark, path, "index_composition").select(
        "index_type", "date", "ticker", "close_price", F.lit("").alias("reason"))
    lines = spark.read.option("recursiveFileLookup", "true").text(path + "_rejected")
    return kept.unionByName(lines.select(F.from_json(
        "value", "index_type string, date date, ticker string, close_price double, reason string").alias("r")
    ).select("r.*"))


def _price_log(spark, sf_dir):
    """Two loads: every tick, then the re-delivered ones."""
    land, again = _landed_payloads(spark, sf_dir), scratch_path(spark, "landing")
    fx.land_bar_payloads(fx.redelivered(fx.ticks(spark, sf_dir)), again)
    log, dead = scratch_path(spark, "price_log"), scratch_path(spark, "dead_letters")
    _ingest_daily(spark, land, log, dead, run_ts=RUN_TS, load_id="batch-1")
    _ingest_daily(spark, again, log, dead, run_ts=SECOND_TS, load_id="batch-2")
    return read_price_log(spark, log)


@query("current_prices_replace")
def current_prices_replace(spark, sf_dir):
    return current_prices(_price_log(spark, sf_dir), "replace")


@query("current_prices_partial")
def current_prices_partial(spark, sf_dir):
    return current_prices(_price_log(spark, sf_dir), "partial")


def _ingested(spark, sf_dir):
    land = _landed_payloads(spark, sf_dir)
    log, dead = scratch_path(spark, "price_log"), scratch_path(spark, "dead_letters")
    _ingest_daily(spark, land, log, dead, run_ts=RUN_TS, load_id="batch-1")
    return land, log, dead


@query("dead_letter_split")
def dead_letter_split(spark, sf_dir):
    _, _, dead = _ingested(spark, sf_dir)
    return read_dead_letters(spark, dead).select(
        "date", "ticker", F.try_variant_get("payload", "$.t", "bigint").alias("t"),
        F.try_variant_get("payload", "$.c", "double").alias("close"), "reason")


@query("ingest_counts")
def ingest_counts(spark, sf_dir):
    land = _landed_payloads(spark, sf_dir)
    return _ingest_counts(landing.read_landed_text(spark, land))


@query("export_performance")
def export_performance(spark, sf_dir):
    base = scratch_path(spark, "csv")
    path = exp.export_performance(fx.performance(spark, sf_dir), base, EQUAL_WEIGHTED,
                                  REPORT_START, REPORT_END)
    return exp.read_csv(spark, path, INDEX_PERFORMANCE)


@query("export_composition")
def export_composition(spark, sf_dir):
    base = scratch_path(spark, "csv")
    path = exp.export_composition(fx.composition(spark, sf_dir), base, SNAPSHOT_DATE,
                                  MARKET_CAP_WEIGHTED)
    schema = StructType([f for f in INDEX_COMPOSITION.fields if f.name != "update_time"])
    return exp.read_csv(spark, path, schema)


@query("export_query")
def export_query(spark, sf_dir):
    base = scratch_path(spark, "csv")
    path = exp.export_query(fx.composition(spark, sf_dir), base, "index_composition")
    return exp.read_csv(spark, path, INDEX_COMPOSITION)


@query("table_audit")
def table_audit(spark, sf_dir):
    return _table_audit({
        "ticker_details": fx.instruments(spark, sf_dir),
        "stock_prices": fx.bars(spark, sf_dir),
        "index_composition": fx.composition(spark, sf_dir),
        "index_performance": fx.performance(spark, sf_dir),
        "index_composition_changes": fx.changes(spark, sf_dir),
    })


@query("table_audit_violations")
def table_audit_violations(spark, sf_dir):
    """The same rules on prices with null tickers (failed ticks) and repeated keys."""
    dirty = _tick_bars(spark, sf_dir).unionByName(_tick_bars(spark, sf_dir, redelivered=True))
    return _table_audit({"stock_prices": dirty})


# 2.3 projections, filters, predicates ------------------------------------------------
@query("project_rename")
def project_rename(spark, sf_dir):
    return fx.bars(spark, sf_dir).select("ticker", "date", F.col("close").alias("close_price"))


@query("literal_columns")
def literal_columns(spark, sf_dir):
    return stamp(fx.bars(spark, sf_dir).select("ticker", "date").withColumn(
        "index_type", F.lit(EQUAL_WEIGHTED)), RUN_TS)


@query("filter_eligible")
def filter_eligible(spark, sf_dir):
    j = con.join_instruments_prices(fx.bars(spark, sf_dir), fx.instruments(spark, sf_dir))
    return (j.filter((F.col("date") == F.lit(SNAPSHOT_DATE).cast("date"))
                     & F.col("market_cap").isNotNull())
            .select("ticker", "date", "close_price", "market_cap"))


@query("filter_date_range")
def filter_date_range(spark, sf_dir):
    return con.bars_in_range(fx.bars(spark, sf_dir), REPORT_START, REPORT_END)


@query("default_window")
def default_window(spark, sf_dir):
    start, end = cal.default_window(AS_OF)
    return con.bars_in_range(fx.bars(spark, sf_dir), start, end)


@query("filter_changed")
def filter_changed(spark, sf_dir):
    lagged = chg.previous_snapshot_lookup(fx.composition(spark, sf_dir))
    return lagged.filter(F.coalesce(chg.changed(), F.lit(False)))


@query("instrument_subset")
def instrument_subset(spark, sf_dir):
    return fx.instruments(spark, sf_dir).filter(F.col("ticker").isin(list(SUBSET_TICKERS)))


@query("filter_index_type")
def filter_index_type(spark, sf_dir):
    return fx.composition(spark, sf_dir).filter(F.col("index_type") == MARKET_CAP_WEIGHTED)


def _tick_bars(spark, sf_dir, redelivered=False):
    t = fx.ticks(spark, sf_dir)
    t = fx.redelivered(t) if redelivered else t
    return t.select("ticker", F.col("epoch_ms").alias("timestamp"), "date",
                    F.col("o").alias("open"), F.col("h").alias("high"), F.col("l").alias("low"),
                    F.col("c").alias("close"), F.col("v").alias("volume"),
                    F.col("n").alias("transactions"), F.col("vw").alias("volume_weighted_avg"),
                    fn.with_default("otc", False).alias("is_otc"),
                    F.lit(True).alias("is_adjusted"))


@query("filter_exclude_otc")
def filter_exclude_otc(spark, sf_dir):
    return _tick_bars(spark, sf_dir).filter(~F.col("is_otc"))


# 2.4 joins -------------------------------------------------------------------------
@query("join_instruments_prices")
def join_instruments_prices(spark, sf_dir):
    active = fx.instruments(spark, sf_dir).filter("active")  # bars of the others have no partner
    return con.join_instruments_prices(fx.bars(spark, sf_dir), active) \
        .select("ticker", "date", "timestamp", "close_price", "market_cap")


@query("join_prices_composition")
def join_prices_composition(spark, sf_dir):
    w = ver.latest_weights(fx.composition(spark, sf_dir)).select(
        "index_type", "date", "ticker", "weight")
    return fx.bars(spark, sf_dir).select("ticker", "date", "close").join(w, ["ticker", "date"])


@query("missing_symbols")
def missing_symbols(spark, sf_dir):
    path = scratch_path(spark, "roster")
    fx.land_roster(spark, sf_dir, path)
    return landing.missing_symbols(landing.roster_scan(spark, path),
                                   fx.stored_tickers(spark, sf_dir))


@query("missing_symbols_batch")
def missing_symbols_batch(spark, sf_dir):
    path = scratch_path(spark, "roster")
    fx.land_roster(spark, sf_dir, path)
    return landing.missing_symbols(landing.roster_scan(spark, path),
                                   fx.stored_tickers(spark, sf_dir), n=DEFAULT_MISSING_BATCH)


@query("previous_snapshot_lookup")
def previous_snapshot_lookup(spark, sf_dir):
    return chg.previous_snapshot_lookup(fx.composition(spark, sf_dir))


# 2.5 aggregations ---------------------------------------------------------------------
def _levels(spark, sf_dir):
    return perf.index_level(fx.bars(spark, sf_dir),
                            ver.latest_weights(fx.composition(spark, sf_dir)))


@query("index_level")
def index_level(spark, sf_dir):
    return _levels(spark, sf_dir)


@query("daily_membership")
def daily_membership(spark, sf_dir):
    members = ver.latest_weights(fx.composition(spark, sf_dir))
    return chg.daily_membership(members.select("index_type", "date", "ticker"))


@query("total_market_cap")
def total_market_cap(spark, sf_dir):
    return con.total_market_cap(fx.composition_runs(spark, sf_dir)[0][1])


@query("constituent_count")
def constituent_count(spark, sf_dir):
    return con.constituent_count(fx.composition_runs(spark, sf_dir)[1][1])


def _tracked(spark, sf_dir, start=None, end=None):
    return perf.track_index_performance(fx.bars(spark, sf_dir), fx.composition(spark, sf_dir),
                                        start, end)


@query("return_summary")
def return_summary(spark, sf_dir):
    return perf.return_summary(_tracked(spark, sf_dir))


@query("composition_insights")
def composition_insights(spark, sf_dir):
    return _insights(ver.snapshot_rows(fx.composition(spark, sf_dir)))


@query("change_event_count")
def change_event_count(spark, sf_dir):
    return chg.change_event_count(chg.detect_index_changes(fx.composition(spark, sf_dir)))


@query("version_collapse_legacy")
def version_collapse_legacy(spark, sf_dir):
    return ver.version_collapse_legacy(fx.composition(spark, sf_dir))


@query("performance_collapse_legacy")
def performance_collapse_legacy(spark, sf_dir):
    return ver.performance_collapse_legacy(fx.performance(spark, sf_dir))


# 2.6 windows ----------------------------------------------------------------------------
@query("composition_snapshot")
def composition_snapshot(spark, sf_dir):
    return ver.composition_snapshot(fx.composition(spark, sf_dir))


@query("performance_history")
def performance_history(spark, sf_dir):
    return perf.performance_history(fx.performance(spark, sf_dir), REPORT_START, REPORT_END)


@query("daily_return")
def daily_return(spark, sf_dir):
    return perf.daily_return(_levels(spark, sf_dir))


@query("latest_weights")
def latest_weights(spark, sf_dir):
    return ver.latest_weights(fx.composition(spark, sf_dir))


@query("membership_lag")
def membership_lag(spark, sf_dir):
    members = ver.latest_weights(fx.composition(spark, sf_dir))
    daily = chg.daily_membership(members.select("index_type", "date", "ticker"))
    return chg.membership_lag(daily)


# 2.7 sorts, limits, top-k ------------------------------------------------------------------
@query("top_n_by_market_cap")
def top_n_by_market_cap(spark, sf_dir):
    cands = con.join_instruments_prices(
        fx.bars(spark, sf_dir), con.eligible_instruments(fx.instruments(spark, sf_dir)))
    return con.top_n_by_market_cap(cands, SERVICE_TOP_N).select(
        "date", "ticker", "close_price", "market_cap")


@query("sort_performance")
def sort_performance(spark, sf_dir):
    return _tracked(spark, sf_dir, REPORT_START, REPORT_END).orderBy("index_type", "date")


@query("sort_composition")
def sort_composition(spark, sf_dir):
    snap = ver.latest_weights(fx.composition(spark, sf_dir))
    return snap.select(*con.COMPOSITION_COLUMNS).orderBy(
        "index_type", "date", F.col("weight").desc(), "ticker")


# 2.9 scalar functions ----------------------------------------------------------------------
@query("fn_epoch_ms_to_date")
def fn_epoch_ms_to_date(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select(
        "event_id", cal.ntz_to_epoch_ms("ts").alias("t"))
    return ev.withColumn("date", cal.epoch_ms_to_date("t"))


@query("fn_previous_trading_day")
def fn_previous_trading_day(spark, sf_dir):
    d = fx.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    return d.withColumn("previous_trading_day", cal.previous_trading_day("date"))


@query("trading_calendar")
def trading_calendar(spark, sf_dir):
    bounds = fx.bars_wide(spark, sf_dir).agg(F.min("date").alias("start"),
                                             F.max("date").alias("end"))
    return cal.trading_calendar(bounds)


@query("fn_format_date")
def fn_format_date(spark, sf_dir):
    b = fx.bars(spark, sf_dir).select("ticker", "date")
    return (b.withColumn("date_text", cal.date_text("date"))
            .withColumn("parsed", cal.parse_date_text("date_text")))


@query("fn_slug")
def fn_slug(spark, sf_dir):
    return (fx.composition(spark, sf_dir).select("index_type").distinct()
            .withColumn("slug", fn.slug("index_type")))


@query("fn_default")
def fn_default(spark, sf_dir):
    return fx.ticks(spark, sf_dir).select("event_id", fn.with_default("otc", False).alias("is_otc"))


@query("fn_percent_text")
def fn_percent_text(spark, sf_dir):
    s = perf.return_summary(_tracked(spark, sf_dir))
    return s.select("index_type", fn.percent_text("total_return").alias("total_return"),
                    fn.percent_text("mean_return").alias("mean_return"),
                    fn.percent_text("volatility").alias("volatility"))


@query("fn_dollar_text")
def fn_dollar_text(spark, sf_dir):
    return fx.instruments(spark, sf_dir).select("ticker", fn.money_text("market_cap").alias("market_cap"))


@query("fn_json_encode")
def fn_json_encode(spark, sf_dir):
    return fx.bars(spark, sf_dir).select(
        "ticker", "timestamp", fn.json_line("ticker", "timestamp", "transactions").alias("json"))


@query("fn_weighted_price")
def fn_weighted_price(spark, sf_dir):
    return fx.composition(spark, sf_dir).select(
        "index_type", "date", "ticker", "update_time",
        fn.weighted_price("weight", "close_price").alias("weighted_price"))


# 2.10 composite jobs ---------------------------------------------------------------------------
@query("index_equal_weighted")
def index_equal_weighted(spark, sf_dir):
    return con.index_equal_weighted(fx.bars(spark, sf_dir), fx.instruments(spark, sf_dir),
                                    SERVICE_TOP_N)


@query("index_market_cap_weighted")
def index_market_cap_weighted(spark, sf_dir):
    return con.index_market_cap_weighted(fx.bars(spark, sf_dir), fx.instruments(spark, sf_dir),
                                         SERVICE_TOP_N)


@query("index_build_range")
def index_build_range(spark, sf_dir):
    return con.index_build_range(fx.bars_wide(spark, sf_dir), fx.instruments_wide(spark, sf_dir),
                                 WIDE_START, WIDE_END, DEFAULT_TOP_N, INDEX_TYPES)


@query("track_index_performance")
def track_index_performance(spark, sf_dir):
    return _tracked(spark, sf_dir, REPORT_START, REPORT_END)


@query("detect_index_changes")
def detect_index_changes(spark, sf_dir):
    return chg.detect_index_changes(fx.composition(spark, sf_dir), REPORT_START, REPORT_END)


@query("composition_get_or_build")
def composition_get_or_build(spark, sf_dir):
    stored = ver.restrict(fx.composition(spark, sf_dir), end=STORED_UNTIL)
    return views.composition_get_or_build(stored, fx.bars(spark, sf_dir),
                                          fx.instruments(spark, sf_dir), SERVICE_TOP_N)


@query("performance_view")
def performance_view(spark, sf_dir):
    return views.performance_view(fx.performance(spark, sf_dir), REPORT_START, REPORT_END)


@query("composition_view")
def composition_view(spark, sf_dir):
    return views.composition_view(fx.composition(spark, sf_dir), SNAPSHOT_DATE)


@query("ingest_daily")
def ingest_daily(spark, sf_dir):
    """Batch ingest of every landed day, then of the re-delivered ticks, each load merged
    into the current table."""
    land = _landed_payloads(spark, sf_dir)
    log, dead = scratch_path(spark, "price_log"), scratch_path(spark, "dead_letters")
    current = scratch_path(spark, "stock_prices_current")
    _ingest_daily(spark, land, log, dead, run_ts=RUN_TS, load_id="batch-1",
                  current_path=current)
    again = scratch_path(spark, "landing")
    fx.land_bar_payloads(fx.redelivered(fx.ticks(spark, sf_dir)), again)
    _ingest_daily(spark, again, log, dead, run_ts=SECOND_TS, load_id="batch-2",
                  current_path=current)
    return read_current(spark, current)


@query("index_changes_legacy")
def index_changes_legacy(spark, sf_dir):
    return chg.index_changes_legacy(fx.composition(spark, sf_dir), REPORT_START, REPORT_END)


@query("index_level_legacy")
def index_level_legacy(spark, sf_dir):
    return perf.index_level_legacy(fx.bars(spark, sf_dir), fx.composition(spark, sf_dir),
                                   REPORT_START, REPORT_END)


@query("performance_history_legacy")
def performance_history_legacy(spark, sf_dir):
    return perf.performance_history_legacy(fx.performance(spark, sf_dir), REPORT_START,
                                           REPORT_END)


@query("composition_snapshot_legacy")
def composition_snapshot_legacy(spark, sf_dir):
    return ver.composition_snapshot_legacy(fx.composition(spark, sf_dir), SNAPSHOT_DATE)


# 2.11 streaming -------------------------------------------------------------------------------
@query("ingest_stream")
def ingest_stream(spark, sf_dir):
    """Incremental pickup of the landed days; each micro-batch merged into the
    current table (files are picked up in batches of at most 10)."""
    land = _landed_payloads(spark, sf_dir)
    log, dead = scratch_path(spark, "price_log"), scratch_path(spark, "dead_letters")
    current = scratch_path(spark, "stock_prices_current")
    checkpoint = scratch_path(spark, "stream_ckpt")
    run_ingest_stream(spark, land, log, dead, checkpoint, run_ts=RUN_TS,
                      current_path=current, max_files_per_trigger=10)
    # more files land in the same folders; the stream picks up only those
    fx.land_bar_payloads(fx.redelivered(fx.ticks(spark, sf_dir)), land, mode="append")
    run_ingest_stream(spark, land, log, dead, checkpoint, run_ts=SECOND_TS,
                      current_path=current, max_files_per_trigger=10)
    return read_current(spark, current)
