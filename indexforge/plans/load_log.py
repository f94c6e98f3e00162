"""The record of loads on a price log: a sequence number per attempt and a commit per load.

``<log>/_commits`` holds ``seq-<number>`` files, one per attempt, created so that no two attempts get
the same number, and ``done-<load>`` files, one per committed load with its sequence, request and counts.  Spark
does not list names that start with an underscore, so readers of the log do not see them.

* A load that is committed is not run again: a replayed batch is skipped and its counts come from the record.
* A repeated attempt of a load that is not gets a new, higher number, so rows are ordered by the attempt that
  brought them, whatever their run timestamps say.
* Loads without a commit are left out by ``committed_rows``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from indexforge.session import names_in, read_small, write_small


def _folder(log_root: str) -> str:
    return f"{log_root.rstrip('/')}/_commits"


def claim_sequence(spark: SparkSession, log_root: str, load_id: str) -> int:
    """A number higher than that of every earlier attempt."""
    taken = [x for x in names_in(spark, _folder(log_root)) if x.startswith("seq-")]
    seq = int(taken[-1][4:]) + 1 if taken else 1
    while not write_small(spark, f"{_folder(log_root)}/seq-{seq:012d}", load_id, overwrite=False):
        seq += 1  # another load took it meanwhile
    return seq


def committed(spark: SparkSession, log_root: str, load_id: str) -> dict | None:
    """The commit record of a load, or None."""
    text = read_small(spark, f"{_folder(log_root)}/done-{load_id}")
    return json.loads(text) if text else None


def commit(spark: SparkSession, log_root: str, load_id: str, record: dict) -> None:
    write_small(spark, f"{_folder(log_root)}/done-{load_id}", json.dumps(record))


def committed_rows(spark: SparkSession, log_root: str) -> DataFrame:
    """The log; while loads are open (begun and not committed), the folders of the others."""
    done = {x[5:] for x in names_in(spark, _folder(log_root)) if x.startswith("done-")}
    there = [x for x in names_in(spark, log_root) if x.startswith("load=")]
    closed = [x for x in there if x[5:] in done]
    if len(closed) == len(there):
        return spark.read.parquet(log_root)
    if not closed:
        return spark.read.parquet(f"{log_root.rstrip('/')}/{there[0]}").limit(0)
    return spark.read.option("basePath", log_root).parquet(*[f"{log_root.rstrip('/')}/{x}" for x in closed])
