"""Column expressions and table helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indexforge.session import drop_scratch, scratch_path

#: The white space that separates words: \x20 and \x09-\x0D.
WS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it in lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ws_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as an array; empty for null, empty and blank texts."""
    t = F.trim(text, F.lit(WS))
    return F.when(t.isNull() | (t == ""), F.array().cast("array<string>")).otherwise(
        F.split(t, "[ \\x09-\\x0D]+"))


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only; every other letter stays."""
    return F.translate(text, UPPER, LOWER)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Folders of the stored tables that are still in use.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Spark's setting that drops an execution's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the lineage, so a
    lost executor costs a read and not the whole job before it.  The shuffle files of the write go
    when it ends; kept until the driver collects its garbage, they fill the disks of a long job."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete the folders of stored tables that nothing reads any more."""
    for t in tables:
        if path := _FOLDERS.pop(t, None):
            drop_scratch(t.sparkSession, path)


def fold_bucket(text: Column, folds: int) -> Column:
    """crc32 of the value's text modulo ``folds``: the documented held-out split."""
    return F.crc32(text.cast("string")) % F.lit(folds)
