"""Append-only versioned tables.

Each run stamps its rows with one explicit ``update_time`` (TIMESTAMP_NTZ, the
same wall-clock meaning as ``TIMESTAMP WITHOUT TIME ZONE``) and appends.
Composition / performance / changes are partitioned by ``index_type`` and ``run_date``, the day of
``update_time``, so a retry looks for its own rows in the files of its run's day only; a run is
range-partitioned by date, so a date filter skips files and row groups through
Parquet statistics without creating one small folder per day.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from indexforge.schemas import (
    INDEX_CHANGES, INDEX_CHANGES_KEY, INDEX_COMPOSITION, INDEX_COMPOSITION_KEY,
    INDEX_PERFORMANCE, INDEX_PERFORMANCE_KEY, not_null_columns,
)
from indexforge.session import drop_scratch, scratch_path
from indexforge.sources.tables import scan_if_exists


#: The partition column that holds the day of a run.
RUN_DATE = "run_date"


def run_timestamp(ts) -> F.Column:
    if isinstance(ts, _dt.datetime):
        ts = ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(ts)).cast("timestamp_ntz")


def stamp(df: DataFrame, run_ts) -> DataFrame:
    """Add the run's ``update_time`` literal."""
    return df.withColumn("update_time", run_timestamp(run_ts))


def split_not_null(df: DataFrame, columns) -> tuple[DataFrame, DataFrame]:
    """(rows satisfying NOT NULL on ``columns``, rows violating it)."""
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))
    return df.filter(ok), df.filter(~ok)


def _ranked(incoming: DataFrame, keys) -> DataFrame:
    """``_nth``: 1 for the kept row of each key.  When a run repeats a key (two bars of a
    ticker on one day) that is the smallest of the rest of the row, so reruns agree; a
    key's rows in one run are bounded by the index size."""
    rest = [c for c in incoming.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*(rest or keys))
    return incoming.withColumn("_nth", F.row_number().over(w))


def _stored_keys(stored: DataFrame, keys, run_ts) -> DataFrame:
    """``update_time`` is part of the key, so only stored rows of the run's own stamp can
    conflict; the filter reaches the scan."""
    if run_ts is not None and "update_time" in keys:
        stored = stored.filter(F.col("update_time") == run_timestamp(run_ts))
        if RUN_DATE in stored.columns:  # a partition column: other days' files are not opened
            stored = stored.filter(F.col(RUN_DATE) == run_timestamp(run_ts).cast("date"))
    return stored.select(*keys)


def conflict_skip(incoming: DataFrame, stored: DataFrame | None,
                  keys=INDEX_COMPOSITION_KEY, run_ts=None) -> DataFrame:
    """``ON CONFLICT (keys) DO NOTHING``: drop keys repeated in the batch and keys
    already stored.  ``append_*`` record what is dropped here."""
    keys = list(keys)
    out = _ranked(incoming, keys).filter("_nth = 1").drop("_nth")
    return out if stored is None else out.join(_stored_keys(stored, keys, run_ts), keys, "left_anti")


def _content(rows: DataFrame, names) -> str:
    """A name for the rows that does not depend on their order."""
    h = F.xxhash64(*names)
    got = rows.agg(F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64(F.lit("again"), *names)).alias("y"),
                   F.count(F.lit(1)).alias("n")).first()
    return f"{got['x'] % (1 << 64):016x}{got['y'] % (1 << 64):016x}-{got['n']}"


def _append(df: DataFrame, path: str, schema, keys, run_ts, partition_by=("index_type", RUN_DATE),
            dead_path: str | None = None, stored: DataFrame | None = None) -> dict:
    """Stamp, skip conflicts, append rows that satisfy the NOT NULL rules.

    Returns the counts {'built', 'written', 'conflicts', 'repeated', 'rejected'}.  Conflicts
    are keys already stored for this run stamp (at ``path``, or in ``stored``), so a
    retried append adds nothing.  Rows that repeat a key of the run and rows that violate
    NOT NULL are written as JSON lines with their reason below ``dead_path``, by default a
    folder of this run beside the table: built = written + conflicts + repeated + rejected.  Each attempt's
    rejects have a folder named by their content: a retry writes its own again, and appends of other
    rows under the same stamp (another strategy of the run) keep theirs.

    The run is computed once, into the shared scratch folder, and written from there
    range-partitioned by (index type, date, ...), so each file covers a narrow date range.
    """
    spark, keys = df.sparkSession, list(keys)
    if stored is None:
        # schema with the run's day: the partition values are read from the folders' names
        stored = scan_if_exists(spark, path, StructType([*schema.fields, StructField(RUN_DATE, DateType())]))
    missing = [c for c in not_null_columns(schema)]
    rows = stamp(df, run_ts).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    rows = _ranked(rows, keys)
    nulls = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in missing])
    rows = rows.withColumn("_reason", F.when(nulls != "", F.concat(F.lit("null_value:"), nulls)).when(
        F.col("_nth") > 1, F.lit("repeated_key")))
    if stored is not None:
        have = _stored_keys(stored, keys, run_ts).distinct().withColumn("_have", F.lit(True))
        rows = rows.join(have, keys, "left").withColumn("_reason", F.when(
            F.col("_reason").isNull() & F.col("_have"), F.lit("conflict")).otherwise(F.col("_reason")))
    names = [f.name for f in schema.fields]
    staging = scratch_path(spark, "append")
    rows.select(*names, "_reason").write.parquet(staging)
    rows = spark.read.parquet(staging)
    n = {r["_reason"]: r["n"] for r in rows.groupBy(F.split("_reason", ":")[0].alias("_reason")).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # at most four kinds
    counts = {"built": sum(n.values()), "written": n.get(None, 0), "conflicts": n.get("conflict", 0),
              "repeated": n.get("repeated_key", 0), "rejected": n.get("null_value", 0)}
    order = [c for c in ("index_type", "date", "ticker") if c in names]
    if counts["written"]:
        (rows.filter("_reason IS NULL").drop("_reason").withColumn(RUN_DATE, F.to_date("update_time"))
         .repartitionByRange(*order).sortWithinPartitions(*order).write.mode("append").partitionBy(*partition_by).parquet(path))
    if counts["repeated"] or counts["rejected"]:
        run = "".join(ch for ch in str(run_ts) if ch.isdigit())
        bad = rows.filter("_reason <> 'conflict'")
        folder = dead_path or f"{path.rstrip('/')}_rejected/run={run}"
        bad.select(F.to_json(F.struct(*names, F.col("_reason").alias("reason"))).alias("value")) \
            .write.mode("overwrite").text(f"{folder.rstrip('/')}/attempt={_content(bad, [*names, '_reason'])}")
    drop_scratch(spark, staging)
    return counts


def append_composition(df: DataFrame, path: str, run_ts, stored: DataFrame | None = None,
                       dead_path: str | None = None) -> dict:
    """Append a run of composition rows; rows rejected by NOT NULL (e.g. a null
    market-cap weight when the selected caps sum to 0) and second bars of a ticker-day
    are counted and dead-lettered."""
    return _append(df, path, INDEX_COMPOSITION, INDEX_COMPOSITION_KEY, run_ts,
                   dead_path=dead_path, stored=stored)


def append_performance(df: DataFrame, path: str, run_ts, dead_path: str | None = None) -> dict:
    return _append(df, path, INDEX_PERFORMANCE, INDEX_PERFORMANCE_KEY, run_ts, dead_path=dead_path)


def append_changes(df: DataFrame, path: str, run_ts, dead_path: str | None = None) -> dict:
    return _append(df, path, INDEX_CHANGES, INDEX_CHANGES_KEY, run_ts, dead_path=dead_path)
