"""Market tables derived from the driver's TPC-H-style test tables.

Instruments come from ``customer`` (or ``supplier`` for the wide set), daily
bars from ``events`` (or ``lineitem``).  Every fixture is a Spark job over the
whole input table, so its work grows with the data.  The same definitions are
written as DuckDB SQL in ``indexforge.plans.oracle``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indexforge.constants import INDEX_TYPES, ROSTER_MARKET
from indexforge.functions.calendar import date_to_epoch_ms, ntz_to_epoch_ms
from indexforge.operators.construct import build_index
from indexforge.operators.performance import index_level, pct_change
from indexforge.operators.versions import latest_weights
from indexforge.operators.changes import detect_index_changes
from indexforge.schemas import STOCK_PRICES, TICKER_DETAILS
from indexforge.sinks.versioned import run_timestamp

# --- fixed values of the fixtures -------------------------------------------
RUN1_TS = "2024-02-01 00:00:00"     # composition run 1: top 5 on every date
RUN2_TS = "2024-02-02 00:00:00"     # composition run 2: top 3 on even days
RUN3_TS = "2024-02-02 12:00:00"     # composition run 3: run 1 again on every fourth day
RUN1_TOP_N = 5
RUN2_TOP_N = 3
PERF_RUNS = (                        # (update_time, start, end) of the performance runs
    ("2024-02-03 00:00:00", "2024-01-01", "2024-01-20"),
    ("2024-02-04 00:00:00", "2024-01-11", "2024-01-30"),
)
CHANGES_TS = "2024-02-05 00:00:00"
PAYLOAD_CHUNK_ROWS = 5000            # bar entries per landed JSON document
ROSTER_PAGE_ROWS = 1000              # roster entries per landed page
LATE_EVERY = 11                      # such event ids are landed under the next day
REDELIVERED_EVERY = 7                # such event ids come again, two days later, at twice the price
# ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticker_of(prefix: str, key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.format_string(f"{prefix}%06d", k)


def as_details(df: DataFrame, values: dict) -> DataFrame:
    return df.select(*[
        (values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in TICKER_DETAILS.fields])


def as_prices(df: DataFrame, values: dict) -> DataFrame:
    return df.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in STOCK_PRICES.fields])


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_instruments: one instrument per customer; cap = balance * 1e6 when positive."""
    c = table(spark, sf_dir, "customer")
    return as_details(c, {
        "ticker": ticker_of("U", "c_custkey"),
        "active": F.col("c_custkey") % 10 != 0,
        "name": F.col("c_name"),
        "market": F.col("c_mktsegment"),
        "market_cap": F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * F.lit(1e6)),
    })


def instruments_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_instruments_wide: one instrument per supplier."""
    s = table(spark, sf_dir, "supplier")
    return as_details(s, {
        "ticker": ticker_of("S", "s_suppkey"),
        "active": F.lit(True),
        "name": F.col("s_name"),
        "market_cap": F.when(F.col("s_acctbal") > 0, F.col("s_acctbal") * F.lit(1e6)),
    })


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_bars: one bar per (user, UTC day) of ``events``; open/close are the values
    of the first/last event by (ts, event_id)."""
    ev = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("date"), "value",
        F.struct("ts", "event_id").alias("_ord"))
    g = ev.groupBy("user_id", "date").agg(
        F.min_by("value", "_ord").alias("open"), F.max("value").alias("high"),
        F.min("value").alias("low"), F.max_by("value", "_ord").alias("close"),
        F.count(F.lit(1)).alias("_n"), F.avg("value").alias("vwap"))
    return as_prices(g, {
        "ticker": ticker_of("U", "user_id"), "timestamp": date_to_epoch_ms("date"),
        "date": F.col("date"), "open": F.col("open"), "high": F.col("high"),
        "low": F.col("low"), "close": F.col("close"), "volume": F.col("_n"),
        "transactions": F.col("_n"), "volume_weighted_avg": F.col("vwap"),
        "is_otc": F.lit(False), "is_adjusted": F.lit(True)})


def bars_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_bars_wide: one bar per (supplier, ship day) of ``lineitem``; price =
    extended price / quantity, close = price of the last line by
    (orderkey, linenumber, partkey, extendedprice)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias("date"), "l_quantity", "l_extendedprice",
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("_ord"))
    g = li.groupBy("l_suppkey", "date").agg(
        F.min_by("price", "_ord").alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", "_ord").alias("close"),
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("_n"),
        F.sum("l_extendedprice").alias("amount"))
    return as_prices(g, {
        "ticker": ticker_of("S", "l_suppkey"), "timestamp": date_to_epoch_ms("date"),
        "date": F.col("date"), "open": F.col("open"), "high": F.col("high"),
        "low": F.col("low"), "close": F.col("close"), "volume": F.col("qty"),
        "transactions": F.col("_n"),
        "volume_weighted_avg": F.try_divide(F.col("amount"), F.col("qty")),
        "is_otc": F.lit(False), "is_adjusted": F.lit(True)})


def composition_runs(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """(update_time, rows) of the runs: 1 = top 5 on every date, 2 = top 3 on even days of
    the month, 3 = the rows of run 1 again on every fourth day; both index types."""
    px, inst = bars(spark, sf_dir), instruments(spark, sf_dir)
    run1 = build_index(px, inst, RUN1_TOP_N, INDEX_TYPES)
    run2 = build_index(px.filter(F.dayofmonth("date") % 2 == 0), inst, RUN2_TOP_N, INDEX_TYPES)
    return [(RUN1_TS, run1), (RUN2_TS, run2), (RUN3_TS, run1.filter(F.dayofmonth("date") % 4 == 0))]


def composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_composition: the three runs appended, with their update_time."""
    runs = [df.withColumn("update_time", run_timestamp(ts)) for ts, df in composition_runs(spark, sf_dir)]
    return reduce(DataFrame.unionByName, runs)


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_performance: two performance runs over overlapping ranges, appended.

    The level is computed once and shared by both runs (as two runs over the
    same stored data would see the same values); each run then takes its range
    and computes returns from its own first day.
    """
    levels = index_level(bars(spark, sf_dir), latest_weights(composition(spark, sf_dir)))
    runs = spark.createDataFrame(
        [(ts, s, e) for ts, s, e in PERF_RUNS], "run_ts string, start string, end string"
    ).select(F.col("run_ts").cast("timestamp_ntz").alias("update_time"),
             F.col("start").cast("date").alias("start"), F.col("end").cast("date").alias("end"))
    # two literal rows: a bounded broadcast side
    ranged = levels.join(F.broadcast(runs), levels["date"].between(runs["start"], runs["end"]))
    ret = pct_change("index_price", ["update_time", "index_type"], "date")
    return ranged.select("date", "index_price", ret.alias("daily_return"), "index_type",
                         "update_time")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_changes: one change run over all dates, both index types."""
    return detect_index_changes(composition(spark, sf_dir)).withColumn(
        "update_time", run_timestamp(CHANGES_TS))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bar entries of the landed payloads: one per event.  The ticker is missing
    for 'error' events (they become dead letters); ``otc`` only on even event ids.
    ``date`` is the landing day: the event's, or the next one for late ids.
    Columns are named ticker / epoch_ms here; the payload keys T / t are only
    given when the JSON is written (they clash in a case-insensitive session)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.date_add(F.to_date("ts"), F.when(F.col("event_id") % LATE_EVERY == 0, 1).otherwise(0)).alias("date"),
        "event_id",
        F.when(F.col("event_type") != "error", ticker_of("U", "user_id")).alias("ticker"),
        ntz_to_epoch_ms("ts").alias("epoch_ms"),
        F.col("value").alias("o"), F.col("value").alias("h"), F.col("value").alias("l"),
        F.col("value").alias("c"), F.lit(1.0).alias("v"), F.lit(1).alias("n"),
        F.col("value").alias("vw"),
        F.when(F.col("event_id") % 2 == 0, F.lit(True)).alias("otc"))


def redelivered(ticks_df: DataFrame) -> DataFrame:
    """Some ticks again in a later file: same key, landed two days later, twice the price, not otc."""
    again = ticks_df.filter(F.col("event_id") % REDELIVERED_EVERY == 0)
    return again.withColumns({"date": F.date_add("date", 2), "otc": F.lit(None).cast("boolean"),
                              **{c: F.col(c) * 2 for c in ("o", "h", "l", "c", "vw")}})


def land_bar_payloads(ticks_df: DataFrame, root: str,
                      chunk_rows: int = PAYLOAD_CHUNK_ROWS, mode: str = "errorifexists") -> None:
    """Write grouped-daily payload documents under ``root/date=YYYY-MM-DD/``.

    A day is split into documents of at most ``chunk_rows`` entries, so no
    document (group) grows with the data.  Entries keep event order.  The documents of
    a day share a file, or several when the day is large: the number of files follows the
    data, not the tasks that made the documents.
    """
    entry = F.struct(F.col("ticker").alias("T"), F.col("epoch_ms").alias("t"),
                     *[F.col(k) for k in ("o", "h", "l", "c", "v", "n", "vw", "otc")])
    docs = (ticks_df.withColumn("_chunk", F.floor(F.col("event_id") / F.lit(chunk_rows)))
            .groupBy("date", "_chunk")
            .agg(F.sort_array(F.collect_list(F.struct(F.col("event_id").alias("k"),
                                                      entry.alias("e")))).alias("_r")))
    payload = F.struct(F.lit(True).alias("adjusted"),
                       F.transform("_r", lambda x: x["e"]).alias("results"))
    (docs.select(F.date_format("date", "yyyy-MM-dd").alias("date"),
                 F.to_json(payload).alias("value"))
     .hint("rebalance", "date")
     .write.mode(mode).partitionBy("date").text(root))


def land_detail_payloads(spark: SparkSession, sf_dir: str, path: str) -> None:
    """One detail payload per customer; ``address`` missing when custkey % 7 = 0,
    ``branding`` missing when custkey % 5 = 0; city = nation name."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")  # 25 rows by definition of the schema
    j = c.join(n, c["c_custkey"].isNotNull() & (c["c_nationkey"] == n["n_nationkey"]), "left")
    ticker = ticker_of("U", "c_custkey")
    address = F.when(F.col("c_custkey") % 7 != 0, F.struct(
        F.concat(F.col("c_custkey").cast("string"), F.lit(" Market St")).alias("address1"),
        F.col("n_name").alias("city")))
    branding = F.when(F.col("c_custkey") % 5 != 0, F.struct(
        F.concat(F.lit("icons/"), ticker, F.lit(".svg")).alias("icon_url"),
        F.concat(F.lit("logos/"), ticker, F.lit(".svg")).alias("logo_url")))
    results = F.struct(
        ticker.alias("ticker"), (F.col("c_custkey") % 10 != 0).alias("active"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("market"),
        F.lit("us").alias("locale"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * F.lit(1e6)).alias("market_cap"),
        address.alias("address"), branding.alias("branding"))
    j.select(results.alias("results")).write.mode("errorifexists").json(path)


def land_roster(spark: SparkSession, sf_dir: str, path: str,
                page_rows: int = ROSTER_PAGE_ROWS) -> None:
    """Roster pages ``{"results": [{ticker, market, active}]}``, one per
    ``page_rows`` customers."""
    c = table(spark, sf_dir, "customer")
    pages = (c.groupBy(F.floor(F.col("c_custkey") / F.lit(page_rows)).alias("_page"))
             .agg(F.collect_list(F.struct(
                 ticker_of("U", "c_custkey").alias("ticker"),
                 F.lit(ROSTER_MARKET).alias("market"),
                 (F.col("c_custkey") % 10 != 0).alias("active"))).alias("results")))
    pages.select("results").write.mode("errorifexists").json(path)


def stored_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored instrument set of the roster fixture: tickers seen in events."""
    ev = table(spark, sf_dir, "events")
    return ev.select(ticker_of("U", "user_id").alias("ticker")).distinct()


def upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_upserts: lineitem rows keyed by (l_orderkey, l_linenumber)."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
        "l_extendedprice", "l_returnflag", "l_quantity")


UPSERT_KEY = ("l_orderkey", "l_linenumber")
UPSERT_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
UPSERT_KEPT = ("l_shipdate", "l_returnflag")
UPSERT_UPDATED = ("l_quantity", "l_extendedprice")

