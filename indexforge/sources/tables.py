"""Stored tables: Parquet with explicit schemas, previews, ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexforge.constants import DEFAULT_PREVIEW_ROWS
from indexforge.schemas import TABLES
from indexforge.session import path_exists


def scan_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Full scan of one of the five tables (``SELECT *``) with its fixed schema.
    Partition folders (index_type=/run_date=/date=) are discovered and pruned by filters; one that is no
    column of the table is not returned."""
    schema, _ = TABLES[name]
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def scan_if_exists(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path``, or None when there is no such path.  Any other failure
    to read it is raised: an unreadable table must not pass for an empty one."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


def preview(df: DataFrame, key, n: int = DEFAULT_PREVIEW_ROWS) -> DataFrame:
    """``SELECT * ... LIMIT n`` made deterministic by ordering on the key
    (planned as a top-k, not a full sort)."""
    key = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*key).limit(n)


def stored_ticker_set(details: DataFrame) -> DataFrame:
    """Tickers already present in the detail table."""
    return details.select("ticker").filter(F.col("ticker").isNotNull()).distinct()


def adhoc_sql(spark: SparkSession, query: str, args=None, **frames: DataFrame) -> DataFrame:
    """Parameterised SQL.  Frames are passed as ``{name}`` references and values
    as named (``:p``) or positional (``?``) parameters -- never spliced into text."""
    return spark.sql(query, args=args, **frames)
