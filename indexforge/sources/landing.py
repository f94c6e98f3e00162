"""Landed market payloads -> typed rows.

Layout: ``<root>/date=YYYY-MM-DD/*.json``, one JSON document per line (a day
may be split into several documents).  Bar payloads are parsed as VARIANT:
the keys ``T`` (ticker) and ``t`` (epoch ms) differ only by case, which a
struct schema cannot hold in a case-insensitive session, and VARIANT lets us
tell a *missing* value from an *unusable* one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from indexforge.constants import ROSTER_MARKET
from indexforge.functions.calendar import epoch_ms_to_date
from indexforge.schemas import BAR_FIELDS, DETAIL_PAYLOAD, ROSTER_PAYLOAD, STOCK_PRICES

_DATE_IN_PATH = r"date=(\d{4}-\d{2}-\d{2})"


def day_paths(root: str, dates: Iterable | None = None) -> list[str]:
    root = root.rstrip("/")
    if dates is None:
        return [root]
    return [f"{root}/date={d}" for d in dates]


def with_source(text: DataFrame) -> DataFrame:
    """Add the request date (from the landing folder) and the source file."""
    path = F.col("_metadata.file_path")
    return text.select(
        "value",
        path.alias("source_file"),
        F.to_date(F.regexp_extract(path, _DATE_IN_PATH, 1), "yyyy-MM-dd").alias("request_date"))


def read_landed_text(spark: SparkSession, root: str, dates=None) -> DataFrame:
    """Landed lines with their source file and request date (batch)."""
    paths = day_paths(root, dates)
    return with_source(spark.read.option("recursiveFileLookup", "true").text(paths))


def _default_false(raw) -> Column:
    """A missing key is false; an explicit null stays null."""
    return F.when(raw.isNull(), F.lit(False)).otherwise(F.try_variant_get(raw, "$", "boolean"))


def explode_bar_entries(text: DataFrame) -> DataFrame:
    """One row per bar entry; an unparsable line yields one row with a null entry.

    Columns: request_date, source_file, raw (the line, only when unparsable),
    corrupt, adjusted, pos, entry (VARIANT of one bar).  Everything document-wide
    is computed *before* the explode, so an exploded row carries only its own
    entry -- never the whole document (a day can be one large document).
    """
    spark = text.sparkSession
    v = F.try_parse_json("value")
    docs = text.select(
        "source_file", "request_date",
        F.when(v.isNull(), F.col("value")).alias("raw"),
        v.isNull().alias("corrupt"),
        _default_false(F.try_variant_get(v, "$.adjusted", "variant")).alias("adjusted"),
        F.variant_get(v, "$.results", "variant").alias("results"))
    return spark.sql(
        """
        SELECT request_date, source_file, raw, corrupt, adjusted, e.pos AS pos, e.value AS entry
        FROM {src}, LATERAL variant_explode_outer(results) AS e
        WHERE corrupt OR e.value IS NOT NULL
        """, src=docs)


def flatten_bars(entries: DataFrame, date_rule: str = "epoch") -> DataFrame:
    """Bar entries -> stock_prices columns plus ``_valid``, ``_reason``, ``_payload``.

    ``date_rule='epoch'``: date = UTC date of ``t`` (monolithic generation).
    ``date_rule='request'``: date = the requested (landing) date (service generation).
    ``otc`` and ``adjusted`` default to false when missing; an explicit null stays null.
    Rejected: unparsable line, null ticker or timestamp, or a present value that
    does not fit its column (e.g. ``n`` above the int range).

    Each payload key is looked up once (as a sub-variant) and then cast; the
    checks read those columns, so no path is resolved twice.
    """
    # positional helper names: payload keys T and t would clash case-insensitively
    keys = [(k, f"_raw{i}", f"_typ{i}", name, t) for i, (k, name, t) in enumerate(BAR_FIELDS)]
    typ_of = {k: typ for k, _, typ, _, _ in keys}
    passthrough = ["entry", "adjusted", "corrupt", "raw", "request_date", "source_file", "pos"]
    step1 = entries.select(*passthrough, *[
        F.try_variant_get("entry", f"$.{k}", "variant").alias(raw) for k, raw, _, _, _ in keys])
    step2 = step1.select(*passthrough, *[c for _, c, _, _, _ in keys], *[
        F.try_variant_get(raw, "$", t).alias(typ) for _, raw, typ, _, t in keys])
    unusable = {k: F.col(raw).isNotNull() & ~F.is_variant_null(raw) & F.col(typ).isNull()
                for k, raw, typ, _, _ in keys}
    bad_value = F.lit(False)
    for u in unusable.values():
        bad_value = bad_value | u
    reason = (F.when(F.col("corrupt"), F.lit("corrupt_record"))
              .when(F.col(typ_of["T"]).isNull(), F.lit("null_ticker"))
              .when(F.col(typ_of["t"]).isNull(), F.lit("null_timestamp"))
              .when(bad_value, F.concat(F.lit("bad_value:"), F.concat_ws(
                  ",", *[F.when(u, F.lit(k)) for k, u in unusable.items()]))))
    step3 = step2.withColumn("_reason", reason)
    cols = {name: F.col(typ) for _, _, typ, name, _ in keys}
    raw_otc = next(raw for k, raw, _, _, _ in keys if k == "otc")
    cols["is_otc"] = F.when(F.col(raw_otc).isNull(), F.lit(False)).otherwise(cols["is_otc"])
    cols["is_adjusted"] = F.col("adjusted")
    if date_rule == "epoch":
        cols["date"] = epoch_ms_to_date(cols["timestamp"])
    elif date_rule == "request":
        cols["date"] = F.col("request_date")
    else:
        raise ValueError(date_rule)
    out = step3.select(
        *[cols[f.name].cast(f.dataType).alias(f.name) for f in STOCK_PRICES.fields],
        F.col("request_date"), F.col("source_file"), F.col("pos").alias("_pos"), "_reason",
        # the original entry is only serialised for rows that become dead letters
        F.when(F.col("corrupt"), F.col("raw"))
         .when(F.col("_reason").isNotNull(), F.to_json("entry")).alias("_payload"))
    return out.withColumn("_valid", F.col("_reason").isNull())


def read_bar_payloads(spark: SparkSession, root: str, dates=None,
                      date_rule: str = "epoch") -> DataFrame:
    """Landed grouped-daily payloads -> flattened bars (valid and rejected)."""
    return flatten_bars(explode_bar_entries(read_landed_text(spark, root, dates)), date_rule)


def flatten_details(raw: DataFrame) -> DataFrame:
    """Detail payloads -> the 27 ticker_details columns; a missing ``address`` or
    ``branding`` object gives nulls."""
    r = "results"
    return raw.select(
        *[F.col(f"{r}.{c}").alias(c) for c in (
            "ticker", "active", "name", "market", "locale", "primary_exchange", "type",
            "currency_name", "cik", "description", "homepage_url", "list_date",
            "market_cap", "phone_number", "total_employees")],
        F.col(f"{r}.address.address1").alias("address1"),
        F.col(f"{r}.address.address2").alias("address2"),
        F.col(f"{r}.address.city").alias("city"),
        F.col(f"{r}.address.state").alias("state"),
        F.col(f"{r}.address.postal_code").alias("postal_code"),
        F.col(f"{r}.branding.icon_url").alias("branding_icon_url"),
        F.col(f"{r}.branding.logo_url").alias("branding_logo_url"),
        *[F.col(f"{r}.{c}").alias(c) for c in (
            "sic_code", "sic_description", "ticker_root", "ticker_suffix",
            "weighted_shares_outstanding")])


def _detail_lines(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType([*DETAIL_PAYLOAD.fields, StructField("_corrupt_record", StringType(), True)])
    return spark.read.schema(schema).json(path)


def read_detail_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Profiles whose every value fits its column; the others are in ``detail_rejects``."""
    lines = _detail_lines(spark, path)
    return flatten_details(lines.filter(F.col("_corrupt_record").isNull()))


def detail_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, payload) of the profiles that are no JSON or hold a value that does not fit,
    for example an employee count above the int range: rejected whole, as the original does."""
    lines = _detail_lines(spark, path).filter(F.col("_corrupt_record").isNotNull())
    return lines.select(F.col("results.ticker").alias("ticker"), F.col("_corrupt_record").alias("payload"))


def roster_entries(spark: SparkSession, path: str) -> DataFrame:
    """All roster entries of the landed pages."""
    return (spark.read.schema(ROSTER_PAYLOAD).json(path)
            .select(F.inline("results")))


def roster_scan(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Active stock tickers in roster order (ticker order); all, or the first ``limit``."""
    out = (roster_entries(spark, path)
           .filter((F.col("market") == ROSTER_MARKET) & F.col("active"))
           .select("ticker").orderBy("ticker"))
    return out.limit(limit) if limit is not None else out


def missing_symbols(roster: DataFrame, stored: DataFrame, n: int | None = None) -> DataFrame:
    """Tickers of ``roster`` (the active stocks of ``roster_scan``) not yet stored, roster
    order kept, first ``n`` (all if None)."""
    out = (roster.select("ticker").join(stored.select("ticker"), "ticker", "left_anti")
           .orderBy("ticker"))
    return out.limit(n) if n is not None else out
