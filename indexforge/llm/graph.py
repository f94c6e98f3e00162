"""Connected components of links held in a DataFrame, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexforge.llm.text import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links`` (a, b).

    Each round points a node's larger neighbours, then its smaller ones, at the smallest node around
    it, until nothing changes; the rounds grow with the logarithm of the longest chain.  Minima are
    combined before the shuffle and every round is written to the shared folder; a hub's
    neighbours meet its minimum in an equi-join that Spark may split.
    """
    e = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = stored(e, "links")
    mark = _mark(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).select(
            "k", F.least("k", "m").alias("m"))
        large = both.filter("v > u").join(low, F.col("u") == F.col("k")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("k"))
        e = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = stored(e, "links")
        new = _mark(e)
        if new == mark:
            break
        mark = new
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
              F.sum(F.col("v").cast("decimal(20,0)")).alias("s")).first()
    return r["n"], r["x"], r["s"]
