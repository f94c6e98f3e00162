"""Daily bar ingestion: landed payloads -> price log + dead letters + counts.

The price table is an append log, one folder per load (``load=<id>``), written
with ``overwrite`` so a retried load replaces itself instead of duplicating.  Every attempt
carries a sequence number, and a load that is committed is not run again (``load_log``).
The current table is a view over the log (``current_prices``): one row per
(ticker, timestamp), chosen by load order; ``merge_into_current`` keeps that table
up to date load by load.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from indexforge.functions.calendar import epoch_ms_to_date
from indexforge.operators.upsert import upsert_partial, upsert_replace
from indexforge.plans import load_log
from indexforge.schemas import PRICES_KEPT, PRICES_UPDATED, STOCK_PRICES, STOCK_PRICES_KEY
from indexforge.session import (
    delete_folder, drop_scratch, names_in, path_exists, read_small, scratch_path, write_small,
)
from indexforge.sinks.dead_letters import write_dead_letters
from indexforge.sources.landing import (
    explode_bar_entries, flatten_bars, read_landed_text, with_source,
)
from indexforge.sources.tables import scan_if_exists

LOAD_ORDER = ("_load_seq", "source_file", "_pos")
CURRENT_PRICES = StructType([*STOCK_PRICES.fields, StructField("key_date", DateType(), True)])
LOG_COLUMNS = [f.name for f in STOCK_PRICES.fields] + ["_load_ts", *LOAD_ORDER]


def ingest_text(text: DataFrame, log_root: str, dead_root: str, load_id: str,
                run_ts, date_rule: str = "request", seq: int = 0) -> dict:
    """Parse, split and write one attempt of a load.  Returns {'total', 'success', 'rejected'}.

    ``text`` has columns value, source_file, request_date.  Counts come from an
    ``Observation`` on the pass that parses the text.
    """
    run_ts, spark = str(run_ts), text.sparkSession
    obs = Observation(f"ingest_{load_id}")
    # parsed once, into the shared folder; both outputs are written from there
    staging = scratch_path(spark, "parsed")
    (flatten_bars(explode_bar_entries(text), date_rule)
     .withColumn("_load_ts", F.lit(run_ts).cast("timestamp_ntz"))
     .withColumn("_load_seq", F.lit(seq).cast("long"))
     .observe(obs, F.count(F.lit(1)).alias("total"), F.count_if(F.col("_valid")).alias("success"))
     .write.parquet(staging))
    bars = spark.read.parquet(staging)
    (bars.filter(F.col("_valid")).select(*LOG_COLUMNS)
     .write.mode("overwrite").parquet(f"{log_root.rstrip('/')}/load={load_id}"))
    write_dead_letters(bars.filter(~F.col("_valid")),
                       f"{dead_root.rstrip('/')}/load={load_id}", run_ts)
    drop_scratch(spark, staging)
    m = obs.get
    total, success = int(m.get("total", 0)), int(m.get("success", 0))
    return {"total": total, "success": success, "rejected": total - success}


def ingest_load(text: DataFrame, log_root: str, dead_root: str, load_id: str, run_ts,
                date_rule: str = "request", current_path: str | None = None, rule: str = "partial",
                request: str = "") -> dict:
    """One load with its commit: a merge that was cut off is finished first, a load that is committed is
    skipped (its counts come from the record), and the commit follows the merge.

    ``request`` says what is loaded; a load id that was used for another request is refused.
    """
    spark = text.sparkSession
    if current_path:
        finish_merge(spark, current_path)
    done = load_log.committed(spark, log_root, load_id)
    if done is not None:
        if done["request"] != request:
            raise ValueError(f"load id {load_id} is taken by another request: {done['request']}")
        return done["counts"]
    seq = load_log.claim_sequence(spark, log_root, load_id)
    counts = ingest_text(text, log_root, dead_root, load_id, run_ts, date_rule, seq)
    record = {"seq": seq, "request": request, "counts": counts}
    if current_path:
        load = spark.read.parquet(f"{log_root.rstrip('/')}/load={load_id}")
        merge_into_current(spark, current_path, load, rule, then=(log_root, load_id, record))
    else:
        load_log.commit(spark, log_root, load_id, record)
    return counts


def ingest_daily(spark: SparkSession, landing_root: str, log_root: str, dead_root: str,
                 dates=None, run_ts=None, load_id: str | None = None,
                 date_rule: str = "request", as_of=None, current_path: str | None = None,
                 rule: str = "partial") -> dict:
    """Batch load of the landed days ``dates`` (all landed days if None; with
    ``as_of``, the previous trading day of ``as_of``, as the scheduled job does).
    With ``current_path`` the load is also merged into the current table."""
    if as_of is not None and dates is None:
        dates = [previous_trading_day_of(as_of)]
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    request = json.dumps([landing_root, sorted(map(str, dates)) if dates is not None else None, date_rule])
    load_id = load_id or "batch-{}-{}".format("".join(ch for ch in str(run_ts) if ch.isdigit()),
                                              hashlib.sha256(request.encode()).hexdigest()[:8])
    text = read_landed_text(spark, landing_root, dates)
    return ingest_load(text, log_root, dead_root, load_id, run_ts, date_rule, current_path, rule, request)


def previous_trading_day_of(as_of) -> _dt.date:
    """Scalar form of the scheduler's target day: the weekday before ``as_of``
    (Saturday, Sunday and Monday all go back to Friday)."""
    d = _dt.date.fromisoformat(str(as_of))
    back = {0: 3, 6: 2}.get(d.weekday(), 1)
    return d - _dt.timedelta(days=back)


def ingest_counts(text: DataFrame, date_rule: str = "request") -> DataFrame:
    """success / total per request date, as a DataFrame."""
    bars = flatten_bars(explode_bar_entries(text), date_rule)
    return (bars.groupBy(F.col("request_date").alias("date"))
            .agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col("_valid")).alias("success"))
            .withColumn("rejected", F.col("total") - F.col("success")))


def read_price_log(spark: SparkSession, log_root: str) -> DataFrame:
    """The rows of all committed loads."""
    return load_log.committed_rows(spark, log_root).select(*LOG_COLUMNS)


def current_prices(log: DataFrame, rule: str = "partial") -> DataFrame:
    """Current stock_prices from the log.

    ``partial`` (service generation): date / is_otc / is_adjusted keep their first
    value, prices follow the newest load.  ``replace``: the newest row wins.
    """
    return _upsert(log, rule, LOAD_ORDER).select(*[f.name for f in STOCK_PRICES.fields])


def write_prices(prices: DataFrame, out_path: str, num_files: int | None = None,
                 date_folders: bool = False) -> None:
    """Write a price table for the index jobs.

    The input is computed once, into the shared scratch folder; the rows of each day are counted there (one
    column is read) and days are dealt in order to files of about equal row counts: small days share a
    file, and a day holding a large share of the rows is split over several by ticker.  Files are sorted, so
    every one covers a narrow date range and date filters skip files and row groups through
    Parquet min/max statistics.  ``date_folders`` adds ``date=`` folders, worth it when a single day is many
    files large.
    """
    spark = prices.sparkSession
    n = num_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staging = scratch_path(spark, "prices")
    prices.write.parquet(staging)
    rows = spark.read.schema(prices.schema).parquet(staging)
    out = placed_by_day(rows, n).sortWithinPartitions("date", "ticker")
    writer = out.write.mode("errorifexists")
    if date_folders:
        writer = writer.partitionBy("date")
    writer.parquet(out_path)
    drop_scratch(spark, staging)


def placed_by_day(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` in ``n`` partitions of about equal row counts, in the order of days.

    A partition's number comes from the row counts of the days before: no sample is
    drawn and the input is not run again for it.  The running total passes over one row per day.
    """
    before = Window.orderBy(F.asc_nulls_first("_day")).rowsBetween(Window.unboundedPreceding, -1)
    days = rows.groupBy(F.col("date").alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    size = F.greatest(F.ceil(F.sum("_n").over(Window.partitionBy()) / F.lit(n)), F.lit(1))
    days = days.select("_day", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), size.alias("_size"))
    days = days.select("_day", F.floor(F.col("_start") / F.col("_size")).cast("int").alias("_first"),
                       F.floor((F.col("_start") + F.col("_n") - 1) / F.col("_size")).cast("int").alias("_last"))
    place = F.col("_first") + F.pmod(F.xxhash64("ticker"), F.col("_last") - F.col("_first") + 1).cast("int")
    return (rows.join(days, F.col("date").eqNullSafe(F.col("_day"))).withColumn("_place", place)
            .repartitionById(n, "_place").drop("_day", "_first", "_last", "_place"))


#: Key days of a load that are named one by one in the partition filter.
MAX_LISTED_DAYS = 2000
#: Rows that a merge may rewrite whatever the size of its load.
SMALL_ROWS = 1_000_000


def _key_days(incoming: DataFrame) -> tuple[list[str], int]:
    """The key days of the rows and their number; for rows of more than
    ``MAX_LISTED_DAYS`` days, the first and last day with ``..`` between them."""
    per_day = incoming.groupBy("key_date").agg(F.count(F.lit(1)).alias("n"))
    days = per_day.limit(MAX_LISTED_DAYS + 1).collect()
    if len(days) <= MAX_LISTED_DAYS:
        return sorted(str(r["key_date"]) for r in days), sum(r["n"] for r in days)
    span = incoming.agg(F.min("key_date").alias("a"), F.max("key_date").alias("b"), F.count(F.lit(1)).alias("n")).first()
    return [str(span["a"]), "..", str(span["b"])], span["n"]


def _all_days(parts: list[list[str]]) -> list[str]:
    """The days of several parts, again named one by one if they are few enough."""
    days = sorted({d for part in parts for d in part})
    if ".." in days or len(days) > MAX_LISTED_DAYS:
        days = [d for d in days if d != ".."]
        return [days[0], "..", days[-1]]
    return days


def _on_days(days: list[str]):
    """A filter on ``key_date`` with literals, so that it prunes the partitions of the current table."""
    if ".." in days:
        first, _, last = map(F.lit, days)
        return F.col("key_date").between(first.cast("date"), last.cast("date"))
    return F.col("key_date").isin([_dt.date.fromisoformat(d) for d in days])


def _key_day_filter(incoming: DataFrame):
    """A filter on ``key_date`` with the load's key days as literals.  A load of more days (its size, not the
    table's, sets their number) is given its first and last day instead."""
    return _on_days(_key_days(incoming)[0])


def _redo(current_path: str) -> str:
    """The folder beside the table that holds a merge on its way: staged rows and the marker ``ready``."""
    return f"{current_path.rstrip('/')}_merge"


def _runs(current_path: str) -> str:
    """The folder beside the table that holds its runs and their ``list``."""
    return f"{current_path.rstrip('/')}_runs"


def _ready(spark: SparkSession, current_path: str) -> dict | None:
    text = read_small(spark, f"{_redo(current_path)}/ready")
    return {"rule": None, "runs": [], **json.loads(text)} if text is not None else None


def _listed(spark: SparkSession, current_path: str) -> dict:
    """The runs of the table, oldest first, and the rule they are merged by."""
    text = read_small(spark, f"{_runs(current_path)}/list")
    return json.loads(text) if text is not None else {"rule": None, "runs": []}


def _ranked(rows: DataFrame, rank: int) -> DataFrame:
    """Merged rows, at most one a key, as an input of a later merge."""
    return rows.select(*CURRENT_PRICES.fieldNames(), F.lit(rank).alias("_rank"),
                       F.lit(None).cast("long").alias("_load_seq"), F.lit(None).cast("string").alias("source_file"),
                       F.lit(None).cast("long").alias("_pos"))


def _run_rows(spark: SparkSession, current_path: str, runs: list[dict]) -> list[DataFrame]:
    return [_ranked(spark.read.schema(CURRENT_PRICES).parquet(f"{_runs(current_path)}/{run['rows']}"), rank)
            for rank, run in enumerate(runs, 1)]


def merge_into_current(spark: SparkSession, current_path: str, load: DataFrame,
                       rule: str = "partial", then: tuple[str, str, dict] | None = None) -> None:
    """Merge one load into the current price table, touching only its days.

    The current table is partitioned by ``key_date`` -- the UTC day of the
    ``timestamp`` key -- so every existing row of a key lives in the partition
    the key itself names, whatever ``date`` the upsert rule kept.  Beside the
    partitions the table may have runs: the merged rows of the newest loads, one a key.
    Many small loads to one large day would rewrite that day many times, so
    a merge rewrites no more than it brings (or ``SMALL_ROWS``):

    1. the load takes in the newest runs, one after the other, while they are not larger than what it has;
    2. if it took in all of them and the stored rows of its days (a literal partition filter) are
       not more either, they are taken in as well, and whole partitions are written; else a new run;
    3. upsert per (ticker, timestamp) with the chosen rule;
    4. rebalance on ``key_date``: few files per day, and a large day is split;
    5. stage the result beside the table and mark it ready;
    6. replace just those partitions (dynamic partition overwrite) or list the run, record the commit ``then``
       (log, load, record) and clear the marker: ``finish_merge``.

    Every run is larger than the next, so they are few, and a row is written again only
    together with at least as many newer ones (or ``SMALL_ROWS``).

    A job lost before the marker leaves the table as it was.  One lost after it may leave
    partitions deleted and not yet replaced: their rows are in the staged copy, ``read_current`` takes them
    from there, and the next load finishes the merge before it does anything else.  One job merges into a
    table at a time.
    """
    finish_merge(spark, current_path)
    cols = [f.name for f in STOCK_PRICES.fields]
    incoming = (load.select(*cols, *LOAD_ORDER)
                .withColumn("key_date", epoch_ms_to_date("timestamp")))
    days, n = _key_days(incoming)
    table = _listed(spark, current_path)
    if table["runs"] and table["rule"] != rule:  # runs of the other rule go into the partitions first
        _merge(spark, current_path, table["rule"], [], table["runs"], [], _all_days([r["days"] for r in table["runs"]]), None)
        table = _listed(spark, current_path)
    older, taken = table["runs"], []
    while older and older[-1]["n"] <= max(n, SMALL_ROWS):
        n += older[-1]["n"]
        older, taken = older[:-1], [older[-1], *taken]
    days = _all_days([days, *[r["days"] for r in taken]])
    _merge(spark, current_path, rule, older, taken, [incoming], days, then,
           run=n if older or _stored_rows(spark, current_path, days) > max(n, SMALL_ROWS) else None)


def _stored_rows(spark: SparkSession, current_path: str, days: list[str]) -> int:
    """Row count of the partitions of ``days``: no column is read."""
    stored = scan_if_exists(spark, current_path, CURRENT_PRICES)
    return stored.filter(_on_days(days)).count() if stored is not None else 0


def _merge(spark: SparkSession, current_path: str, rule: str, older: list[dict], taken: list[dict],
           incoming: list[DataFrame], days: list[str], then, run: int | None = None) -> None:
    """Upsert ``taken`` runs and ``incoming`` rows: into the partitions of ``days``, or with ``run`` (the number
    of rows that go in) into a new run after the ``older`` ones."""
    pieces = _run_rows(spark, current_path, taken)
    pieces += [df.withColumn("_rank", F.lit(len(taken) + 1)) for df in incoming]
    stored = scan_if_exists(spark, current_path, CURRENT_PRICES) if run is None else None
    if stored is not None:
        pieces.insert(0, _ranked(stored.filter(_on_days(days)), 0))
    merged = (_upsert(reduce(DataFrame.unionByName, pieces), rule, ["_rank", *LOAD_ORDER])
              .withColumn("key_date", epoch_ms_to_date("timestamp"))
              .hint("rebalance", "key_date"))
    name = f"rows-{uuid.uuid4().hex[:12]}"
    work = {"staged": None if run is not None else name, "then": then, "rule": rule, "runs": older}
    if run is not None:
        merged.write.parquet(f"{_runs(current_path)}/{name}")
        work["runs"] = [*older, {"rows": name, "n": run, "days": days}]
    else:
        merged.write.parquet(f"{_redo(current_path)}/{name}")
    write_small(spark, f"{_redo(current_path)}/ready", json.dumps(work))
    finish_merge(spark, current_path)


def finish_merge(spark: SparkSession, current_path: str) -> bool:
    """Finish a merge that is marked ready, if there is one; may be repeated from any point."""
    redo, runs = _redo(current_path), _runs(current_path)
    if not path_exists(spark, redo):
        return False
    work = _ready(spark, current_path)
    if work is not None:
        if work["staged"]:
            _swap(spark, f"{redo}/{work['staged']}", current_path)
        if work["runs"]:
            write_small(spark, f"{runs}/list", json.dumps({"rule": work["rule"], "runs": work["runs"]}))
        else:
            delete_folder(spark, f"{runs}/list")
        if work["then"]:
            load_log.commit(spark, *work["then"])
        delete_folder(spark, f"{redo}/ready")
        kept = {"list", *(r["rows"] for r in work["runs"])}
        for name in names_in(spark, runs):
            if name not in kept:
                delete_folder(spark, f"{runs}/{name}")
    delete_folder(spark, redo)  # with what an attempt staged and did not mark
    return work is not None


def _swap(spark: SparkSession, staged: str, current_path: str) -> None:
    (spark.read.schema(CURRENT_PRICES).parquet(staged).sortWithinPartitions("key_date", "ticker")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("key_date").parquet(current_path))


def read_current(spark: SparkSession, current_path: str) -> DataFrame:
    """The current table: its partitions, and over them its runs.  Days of a merge that is ready and not
    finished come from its staged copy."""
    work = _ready(spark, current_path)
    if work is None or not work["staged"]:
        rows = spark.read.schema(CURRENT_PRICES).parquet(current_path)
    else:
        rows = spark.read.schema(CURRENT_PRICES).parquet(f"{_redo(current_path)}/{work['staged']}")
        stored = scan_if_exists(spark, current_path, CURRENT_PRICES)
        if stored is not None:
            days = rows.select(F.col("key_date").alias("_day")).distinct()
            rows = rows.unionByName(stored.join(days, F.col("key_date").eqNullSafe(F.col("_day")), "left_anti"))
    cols = [f.name for f in STOCK_PRICES.fields]
    table = work or _listed(spark, current_path)
    if not table["runs"]:
        return rows.select(*cols)
    touched = _on_days(_all_days([r["days"] for r in table["runs"]]))
    pieces = [_ranked(rows.filter(touched), 0), *_run_rows(spark, current_path, table["runs"])]
    merged = _upsert(reduce(DataFrame.unionByName, pieces), table["rule"], ["_rank"])
    return rows.filter(~F.coalesce(touched, F.lit(False))).select(*cols).unionByName(merged.select(*cols))


def _upsert(df: DataFrame, rule: str, order) -> DataFrame:
    key = list(STOCK_PRICES_KEY)
    if rule == "partial":
        return upsert_partial(df, key, order, PRICES_KEPT, PRICES_UPDATED)
    if rule == "replace":
        return upsert_replace(df, key, order, [f.name for f in STOCK_PRICES.fields])
    raise ValueError(rule)


__all__ = ["finish_merge", "ingest_load", "merge_into_current", "read_current", "write_prices", "current_prices", "ingest_counts", "ingest_daily",
           "ingest_text", "read_price_log", "with_source"]
