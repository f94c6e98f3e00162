"""Explicit schemas for the five stored tables and the landed payloads.

Nothing is inferred: readers always pass one of these.
"""

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampNTZType,
)


def _s(*fields):
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# ticker_details, key ticker
TICKER_DETAILS = _s(
    ("ticker", StringType(), True),
    ("active", BooleanType(), True),
    ("name", StringType(), True),
    ("market", StringType(), True),
    ("locale", StringType(), True),
    ("primary_exchange", StringType(), True),
    ("type", StringType(), True),
    ("currency_name", StringType(), True),
    ("cik", StringType(), True),
    ("description", StringType(), True),
    ("homepage_url", StringType(), True),
    ("list_date", DateType(), True),
    ("market_cap", DoubleType(), True),
    ("phone_number", StringType(), True),
    ("total_employees", IntegerType(), True),
    ("address1", StringType(), True),
    ("address2", StringType(), True),
    ("city", StringType(), True),
    ("state", StringType(), True),
    ("postal_code", StringType(), True),
    ("branding_icon_url", StringType(), True),
    ("branding_logo_url", StringType(), True),
    ("sic_code", StringType(), True),
    ("sic_description", StringType(), True),
    ("ticker_root", StringType(), True),
    ("ticker_suffix", StringType(), True),
    ("weighted_shares_outstanding", DoubleType(), True),
)
TICKER_DETAILS_KEY = ("ticker",)

# stock_prices, key (ticker, timestamp); timestamp is epoch milliseconds
STOCK_PRICES = _s(
    ("ticker", StringType(), True),
    ("timestamp", LongType(), True),
    ("date", DateType(), True),
    ("open", DoubleType(), True),
    ("high", DoubleType(), True),
    ("low", DoubleType(), True),
    ("close", DoubleType(), True),
    ("volume", DoubleType(), True),
    ("transactions", IntegerType(), True),
    ("volume_weighted_avg", DoubleType(), True),
    ("is_otc", BooleanType(), True),
    ("is_adjusted", BooleanType(), True),
)
STOCK_PRICES_KEY = ("ticker", "timestamp")
# service-generation upsert: these keep their first value, the rest follow the newest row
PRICES_KEPT = ("date", "is_otc", "is_adjusted")
PRICES_UPDATED = ("open", "high", "low", "close", "volume", "transactions",
                  "volume_weighted_avg")

# index_composition, unique (date, ticker, index_type, update_time)
INDEX_COMPOSITION = _s(
    ("date", DateType(), False),
    ("ticker", StringType(), False),
    ("close_price", DoubleType(), False),
    ("weight", DoubleType(), False),
    ("market_cap", DoubleType(), True),
    ("index_type", StringType(), False),
    ("update_time", TimestampNTZType(), True),
)
INDEX_COMPOSITION_KEY = ("date", "ticker", "index_type", "update_time")

# index_performance, key (date, index_type, update_time)
INDEX_PERFORMANCE = _s(
    ("date", DateType(), False),
    ("index_price", DoubleType(), False),
    ("daily_return", DoubleType(), False),
    ("index_type", StringType(), False),
    ("update_time", TimestampNTZType(), True),
)
INDEX_PERFORMANCE_KEY = ("date", "index_type", "update_time")

# index_composition_changes; index_type is added so two indices cannot collide
INDEX_CHANGES = _s(
    ("date", DateType(), False),
    ("symbols", StringType(), False),
    ("prev_date", DateType(), True),
    ("prev_symbols", StringType(), True),
    ("index_type", StringType(), False),
    ("update_time", TimestampNTZType(), True),
)
INDEX_CHANGES_KEY = ("date", "index_type", "update_time")

TABLES = {
    "ticker_details": (TICKER_DETAILS, TICKER_DETAILS_KEY),
    "stock_prices": (STOCK_PRICES, STOCK_PRICES_KEY),
    "index_composition": (INDEX_COMPOSITION, INDEX_COMPOSITION_KEY),
    "index_performance": (INDEX_PERFORMANCE, INDEX_PERFORMANCE_KEY),
    "index_composition_changes": (INDEX_CHANGES, INDEX_CHANGES_KEY),
}


def not_null_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


# --- landed payloads ---------------------------------------------------------
# Grouped daily bars: {"adjusted": bool, "results": [{T, t, o, h, l, c, v, n, vw, otc}]}.
# T and t differ only by case, so bars are parsed as VARIANT (case-sensitive
# paths) instead of through a struct schema.
BAR_FIELDS = (  # payload key, target column, Spark type name
    ("T", "ticker", "string"),
    ("t", "timestamp", "bigint"),
    ("o", "open", "double"),
    ("h", "high", "double"),
    ("l", "low", "double"),
    ("c", "close", "double"),
    ("v", "volume", "double"),
    ("n", "transactions", "int"),
    ("vw", "volume_weighted_avg", "double"),
    ("otc", "is_otc", "boolean"),
)

ADDRESS = _s(
    ("address1", StringType(), True), ("address2", StringType(), True),
    ("city", StringType(), True), ("state", StringType(), True),
    ("postal_code", StringType(), True),
)
BRANDING = _s(("icon_url", StringType(), True), ("logo_url", StringType(), True))

# One instrument detail payload ({"results": {...}}).
DETAIL_RESULT = StructType(
    [f for f in TICKER_DETAILS.fields
     if f.name not in ("address1", "address2", "city", "state", "postal_code",
                       "branding_icon_url", "branding_logo_url")]
    + [StructField("address", ADDRESS, True), StructField("branding", BRANDING, True)]
)
DETAIL_PAYLOAD = StructType([StructField("results", DETAIL_RESULT, True)])

ROSTER_ENTRY = _s(("ticker", StringType(), True), ("market", StringType(), True),
                  ("active", BooleanType(), True))
ROSTER_PAYLOAD = StructType([StructField("results", ArrayType(ROSTER_ENTRY), True)])
