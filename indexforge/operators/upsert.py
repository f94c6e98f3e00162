"""Upserts over an append log.

Parquet tables cannot be updated in place, so a table is an append log with a
sequence column and its current state is a view: one row per key, chosen by
sequence.  The view is an aggregate (``max_by`` / ``min_by`` over a struct)
rather than a ranking window, so it is computed with a map-side partial
aggregate: a key holding a third of all rows is reduced inside each map task
before the shuffle instead of being sorted in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _seq(order: Sequence[str] | str) -> Column:
    if isinstance(order, str):
        return F.col(order)
    return F.struct(*[F.col(c) for c in order])


def upsert_replace(log: DataFrame, key: Sequence[str], order: Sequence[str] | str,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """``INSERT OR REPLACE``: the newest row of a key wins in every column
    (nulls included)."""
    key = list(key)
    columns = [c for c in (columns or log.columns) if c not in key]
    newest = F.max_by(F.struct(*[F.col(c) for c in columns]), _seq(order)).alias("_v")
    return log.groupBy(*key).agg(newest).select(*key, *[F.col(f"_v.{c}").alias(c) for c in columns])


def upsert_partial(log: DataFrame, key: Sequence[str], order: Sequence[str] | str,
                   kept: Sequence[str], updated: Sequence[str]) -> DataFrame:
    """``ON CONFLICT DO UPDATE SET <updated>``: ``kept`` columns keep the value of
    the first row of the key, ``updated`` columns follow the newest row (an
    incoming null overwrites)."""
    key, kept, updated = list(key), list(kept), list(updated)
    seq = _seq(order)
    first = F.min_by(F.struct(*[F.col(c) for c in kept]), seq).alias("_k")
    last = F.max_by(F.struct(*[F.col(c) for c in updated]), seq).alias("_u")
    return (log.groupBy(*key).agg(first, last)
            .select(*key, *[F.col(f"_k.{c}").alias(c) for c in kept],
                    *[F.col(f"_u.{c}").alias(c) for c in updated]))

