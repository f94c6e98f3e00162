"""Summary figures shown next to a composition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexforge.operators.exact import exact_sums


def composition_insights(snapshot: DataFrame) -> DataFrame:
    """Constituent count and mean close per (index_type, date); the mean is of the exact,
    order-independent sum over the date's members."""
    sums = exact_sums(snapshot, ["index_type", "date"], F.col("close_price"), "_sum", "constituents", "_n")
    return sums.select("index_type", "date", "constituents", F.try_divide("_sum", "_n").alias("mean_close"))
