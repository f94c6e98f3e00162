"""Line dedup by site-relative frequency.

Pages are grouped by host.  The share of a host's pages that contain a line is
``pages with the line / pages of the host``; lines whose share exceeds ``max_share`` (and that
are on at least ``min_pages`` pages of the host) are boilerplate and are dropped from every page
of that host.

The ratio is 1% of a host's pages, and 3 pages at least.  A host has several templates, sections and
licences, each on a part of its pages, so the line of one of them is on a few percent of the pages and
not on a tenth; a line that is written for its page is on one page, or on a few that quote or copy it,
and their number does not grow with the host.  Under 300 pages the floor decides: two pages
may quote one another.  A line on 1% or less of a larger host stays.

Scale: lines are reduced to distinct hashes inside each row, and counts per (host, line) are
combined in the map tasks, so a host or a line with a third of all rows sends one row per task.
A host has at most ``distinct lines per page / max_share`` boilerplate lines, so its list is
bounded by the page length and not by the number of pages.  The lists are counted: up to
``max_broadcast_lines`` (16 bytes each) they are broadcast and the texts are not shuffled; beyond
that they join the pages by host as a plain equi-join, in which Spark splits a hot host.

Defined results: a null text stays null and an empty one stays empty; a null host is a host of
its own; lines without a word stay; repeated rows are pages of their own; all columns of the
input are kept and only ``text`` changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexforge.llm.text import WS, stored


def _line_key(line: Column) -> Column:
    return F.trim(line, F.lit(WS))


def _hashes(text: Column) -> Column:
    """Distinct (xxhash64, crc32) of the lines with a word: 96 bits name a line."""
    keys = F.filter(F.transform(F.split(text, "\n"), _line_key), lambda k: k != "")
    return F.transform(F.array_distinct(keys),
                       lambda k: F.struct(F.xxhash64(k).alias("h"), F.crc32(k).alias("c")))


#: The share of a host's pages above which a line is boilerplate.
MAX_SHARE = 0.01


def boilerplate_lines(pages: DataFrame, host: str = "source", text: str = "text", *,
                      max_share: float = MAX_SHARE, min_pages: int = 3) -> DataFrame:
    """(host, lines): the line hashes over ``max_share`` of each host that has any."""
    p = pages.select(F.col(host).alias("host"), _hashes(F.col(text)).alias("lines"))
    # the empty struct row of each page counts the pages of the host in the same aggregate
    one = F.struct(F.lit(None).cast("long").alias("h"), F.lit(None).cast("long").alias("c"))
    rows = p.select("host", F.explode(F.concat(F.array(one), F.coalesce(
        "lines", F.array().cast("array<struct<h:bigint,c:bigint>>")))).alias("line"))
    n = rows.groupBy("host", F.col("line.h").alias("h"), F.col("line.c").alias("c")).agg(
        F.count(F.lit(1)).alias("n"))
    n = n.filter((F.col("n") >= min_pages) | F.col("h").isNull())
    total = n.filter(F.col("h").isNull()).select(F.col("host").alias("host_"), F.col("n").alias("pages"))
    return (n.filter(F.col("h").isNotNull()).join(total, F.col("host").eqNullSafe(F.col("host_")))
            .filter(F.col("n") > max_share * F.col("pages"))
            .groupBy("host").agg(F.collect_list(F.struct("h", "c")).alias("lines")))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", *,
                     max_share: float = MAX_SHARE, min_pages: int = 3,
                     max_broadcast_lines: int = 500_000) -> DataFrame:
    """``pages`` with boilerplate lines removed from ``text``, and ``__dropped`` lines counted."""
    bad = stored(boilerplate_lines(pages, host, text, max_share=max_share, min_pages=min_pages), "boilerplate")
    size = bad.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()[0]
    bad = bad.select(F.col("host").alias("__host"), F.col("lines").alias("__bad"))
    if size <= max_broadcast_lines:
        bad = F.broadcast(bad)
    j = pages.join(bad, F.col(host).eqNullSafe(F.col("__host")), "left")
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col("__bad"), F.struct(
        F.xxhash64(_line_key(x)).alias("h"), F.crc32(_line_key(x)).alias("c"))))
    j = j.withColumn("__kept", F.when(F.col("__bad").isNull(), lines).otherwise(kept))
    j = j.withColumn("__dropped", F.coalesce(F.size(lines) - F.size("__kept"), F.lit(0)).cast("long"))
    return j.withColumn(text, F.array_join("__kept", "\n")).drop("__host", "__bad", "__kept")
