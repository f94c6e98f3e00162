"""Small scalar expressions used across the jobs (all built-in, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def slug(x) -> Column:
    """'Equal Weighted' -> 'equal_weighted' (lower case, space -> underscore)."""
    return F.replace(F.lower(_c(x)), F.lit(" "), F.lit("_"))


def _fixed2(x, pattern: str) -> Column:
    """Two-decimal text; missing / NaN / infinite values print as nan / inf / -inf."""
    v = _c(x).cast("double")
    special = (F.when(v.isNull() | F.isnan(v), F.lit("nan"))
               .when(v == float("inf"), F.lit("inf"))
               .when(v == float("-inf"), F.lit("-inf")))
    return (F.when(special.isNotNull(), F.format_string(pattern.replace("%.2f", "%s"), special))
            .otherwise(F.format_string(pattern, v)))


def percent_text(x) -> Column:
    """'12.35%' -- presentation only, the queries return numbers."""
    return _fixed2(x, "%.2f%%")


def money_text(x) -> Column:
    """'$12.35'."""
    return _fixed2(x, "$%.2f")


def json_line(*cols) -> Column:
    """A record as one JSON line (null fields are left out)."""
    return F.to_json(F.struct(*[_c(c) for c in cols]))


def weighted_price(weight, close) -> Column:
    return _c(weight) * _c(close)


def cap_share(cap, total) -> Column:
    """cap / total, null when the total is 0 (ANSI-safe)."""
    return F.try_divide(_c(cap), _c(total))


def equal_share(n) -> Column:
    return F.try_divide(F.lit(1.0), _c(n).cast("double"))


def with_default(x, default) -> Column:
    """A missing payload key or value falls back to ``default``."""
    return F.coalesce(_c(x), F.lit(default))
