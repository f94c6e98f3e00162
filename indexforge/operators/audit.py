"""Table rules (primary key, unique, NOT NULL) checked as an audit job.

Parquet does not enforce constraints, so every rule becomes one aggregate:
duplicate keys via ``groupBy(key).count()`` (partially aggregated before the
shuffle) and null counts via ``count_if`` in a single scan per table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexforge.schemas import TABLES, not_null_columns

AUDIT_COLUMNS = ["table_name", "rule", "column_name", "violations"]


def audit_table(name: str, df: DataFrame, key=None, not_null=None) -> DataFrame:
    """Rows (table_name, rule, column_name, violations) for one table.

    ``duplicate_key`` counts rows beyond the first of each key; ``null_value``
    counts nulls in key and NOT NULL columns.
    """
    schema, default_key = TABLES.get(name, (None, ()))
    key = list(key if key is not None else default_key)
    if not_null is None:
        not_null = not_null_columns(schema) if schema is not None else []
    parts = []
    if key:
        dup = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
               .agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0))
                    .cast("bigint").alias("violations"))
               .select(F.lit(name).alias("table_name"), F.lit("duplicate_key").alias("rule"),
                       F.lit(",".join(key)).alias("column_name"), "violations"))
        parts.append(dup)
    cols = list(dict.fromkeys(key + list(not_null)))
    if cols:
        wide = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
        stack = ", ".join(f"'{c}', `{c}`" for c in cols)
        parts.append(wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, violations)")
                     .select(F.lit(name).alias("table_name"), F.lit("null_value").alias("rule"),
                             "column_name", "violations"))
    return reduce(DataFrame.unionByName, parts)


def table_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Audit several tables; one row per (table, rule, column)."""
    return reduce(DataFrame.unionByName,
                  [audit_table(n, df) for n, df in tables.items()])
