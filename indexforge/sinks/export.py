"""CSV export.

Each export is a folder named like the original file
(``performance_<type>_<start>_<end>.csv``) holding the part files of the
distributed write -- the rows never pass through one task or the driver.
Empty results write nothing, as in the original.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from indexforge.functions.scalar import slug
from indexforge.operators.versions import restrict, composition_snapshot
from indexforge.session import delete_folder, replace_folder


def _slug_text(s: str) -> str:
    return s.lower().replace(" ", "_")


def plain_number(c: Column) -> Column:
    """A number as text without an exponent and with every digit: the decimal point of the shortest text
    that names the double is moved, so reading it gives the same double (7.95422E9 -> 7954220000.0)."""
    text = c.cast("string")
    part = lambda k: F.regexp_extract(text, r"^(-?)(\d)\.(\d+?)0*E(-?\d+)$", k)
    digits = F.concat(part(2), F.when(part(3) == "0", F.lit("")).otherwise(part(3)))
    point = part(4).try_cast("int") + F.lit(1)  # digits before the point
    size = F.length(digits)
    moved = (F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
             .when(point >= size, F.concat(digits, F.repeat(F.lit("0"), point - size), F.lit(".0")))
             .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, size))))
    return F.when(text.contains("E"), F.concat(part(1), moved)).otherwise(text)


def write_csv(df: DataFrame, path: str) -> str:
    """Write with a header; returns the path, or '' when there is nothing to write.

    The query runs once, into a folder beside ``path`` that takes its place when it is complete,
    so a lost job leaves an earlier export as it was.  Tasks write the partitions
    they have: the part files of a sorted result, in the order of their names, are sorted.
    """
    spark = df.sparkSession
    doubles = {f.name: plain_number(F.col(f.name)) for f in df.schema.fields
               if isinstance(f.dataType, (DoubleType, FloatType))}
    counted, part = Observation(), f"{path.rstrip('/')}.part-{uuid.uuid4().hex[:12]}"
    (df.withColumns(doubles) if doubles else df).observe(counted, F.count(F.lit(1)).alias("rows")).write.option(
        "header", True).csv(part)
    some = counted.get.get("rows", 0) > 0
    if some:
        replace_folder(spark, part, path)
    else:
        delete_folder(spark, part)
    return path if some else ""


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def export_performance(performance: DataFrame, base: str, index_type: str, start, end) -> str:
    """All stored versions in the range (no dedup)."""
    df = restrict(performance, index_type, start=start, end=end)
    name = f"performance_{_slug_text(index_type)}_{start}_{end}.csv"
    return write_csv(df, f"{base.rstrip('/')}/{name}")


def export_composition(composition: DataFrame, base: str, date, index_type: str) -> str:
    """The deduplicated snapshot of one date."""
    df = composition_snapshot(composition, date, index_type)
    name = f"composition_{_slug_text(index_type)}_{date}.csv"
    return write_csv(df, f"{base.rstrip('/')}/{name}")


def export_query(df: DataFrame, base: str, name: str) -> str:
    """Any query result (e.g. from ``adhoc_sql``) as CSV."""
    return write_csv(df, f"{base.rstrip('/')}/{name}.csv")


__all__ = ["export_composition", "export_performance", "export_query", "read_csv",
           "write_csv", "slug"]
