"""Sums of doubles that do not depend on the order of the rows.

Floating-point addition rounds at every step, so its result depends on the partition layout.  Here a sum is
exact until one final rounding (to nearest, ties to even):

1. Every finite double is split into three integer limbs of ``BITS`` bits, named by the exponent bin
   of the highest one.  53 mantissa bits never span more.
2. Limbs are added as integers per (group, bin): a plain partial hash aggregate.
3. A group has at most ``len(BINS)`` bins, whatever its rows.  They become the digits of one
   long number: carries are passed up, the sign is taken out, and the four highest digits with a sticky bit for
   the rest are rounded once.

Null values are skipped and a group without values is null.  NaN and infinities give what addition gives.
Limb sums are 64-bit: a group may have 2**33 rows; beyond, the query fails rather than wraps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 28
#: Exponent bins of doubles, from 2**-1074 to 2**1023.
LOW, HIGH = -1074 // BITS, 1023 // BITS
#: Bins that limbs and their carries can reach: two below the lowest, and two above the highest for sums.
BINS = range(LOW - 2, HIGH + 4)


def _power(bin_: Column, half: int, first: int) -> Column:
    """2 ** (half * bin), looked up: exact, and in range where the whole power is not."""
    table = F.array(*[F.lit(2.0 ** (half * k)) for k in range(first, BINS[-1] + 1)])
    return F.get(table, bin_ - F.lit(first))


def limbs(value: Column) -> list[Column]:
    """[bin, limb of the bin, limb one bin lower, limb two lower]; nulls for values without limbs."""
    size = F.abs(value)
    finite = size.isNotNull() & ~F.isnan(size) & (size < F.lit(float("inf")))
    bin_ = F.when(finite & (size > 0), F.floor(F.log2(size) / F.lit(float(BITS))).cast("int"))
    down = _power(-bin_, BITS // 2, -BINS[-1])
    scaled = size * down * down  # in [1, 2**BITS), but for the rounding of the logarithm
    sign, shift, out = F.when(value < 0, F.lit(-1)).otherwise(F.lit(1)), F.lit(float(2 ** BITS)), [bin_]
    for _ in range(3):
        limb = F.floor(scaled)
        out.append(limb * sign)
        scaled = (scaled - limb) * shift
    return out


def _rounded(digits: Column) -> Column:
    """The double nearest to the number whose signed 64-bit digits, lowest first, have ``BITS`` bits each."""
    mask = F.lit((1 << BITS) - 1).cast("long")
    zero = F.struct(F.lit(0).cast("long").alias("c"), F.array().cast("array<bigint>").alias("d"))

    def carried(x: Column) -> Column:
        def step(a: Column, v: Column) -> Column:
            t = a["c"] + v
            return F.struct(F.shiftright(t, BITS).alias("c"), F.concat(a["d"], F.array(t.bitwiseAND(mask))).alias("d"))
        return F.aggregate(x, zero, step)

    wide = lambda c: c.cast("decimal(38,0)")
    start = F.struct(F.lit(0).alias("n"), wide(F.lit(0)).alias("m"), F.lit(0).alias("s"), F.lit(BINS[-1] + 1).alias("e"))

    def take(a: Column, d: Column) -> Column:
        skip, full = (a["n"] == 0) & (d == 0), a["n"] == 4
        return F.struct(
            F.when(skip | full, a["n"]).otherwise(a["n"] + 1).alias("n"),
            F.when(skip | full, a["m"]).otherwise(wide(a["m"] * F.lit(1 << BITS) + d)).alias("m"),
            F.when(full & (d != 0), F.lit(1)).otherwise(a["s"]).alias("s"),
            F.when(full, a["e"]).otherwise(a["e"] - 1).alias("e"))

    def value(top: Column) -> Column:
        mantissa = wide(top["m"] * F.lit(4) + top["s"]).cast("double")
        half = _power(top["e"], BITS // 2, BINS[0] - 1)
        return mantissa * half * (half / F.lit(4.0))

    def signed(x: Column) -> Column:
        sign = F.when(carried(x)["c"] < 0, F.lit(-1)).otherwise(F.lit(1))
        return F.get(F.transform(F.array(sign), lambda s: s * F.aggregate(
            F.reverse(carried(F.transform(x, lambda v: v * s))["d"]), start, take, value)), F.lit(0))

    return F.get(F.transform(F.array(digits), signed), F.lit(0))


def exact_sums(df: DataFrame, keys: Sequence[str], value: Column, name: str, rows: str | None = None,
               values: str | None = None) -> DataFrame:
    """``keys`` and the exact sum of ``value`` as ``name`` per group; on request the count of rows and of non-null values."""
    keys = list(keys)
    split = df.select(*keys, value.cast("double").alias("_x")).select(
        *keys, "_x", *[c.alias(n) for n, c in zip(("_bin", "_l0", "_l1", "_l2"), limbs(F.col("_x")))])
    odd = F.when(F.isnan("_x") | (F.abs("_x") == float("inf")), F.col("_x"))
    bins = split.groupBy(*keys, "_bin").agg(
        *[F.sum(f"_l{k}").alias(f"_l{k}") for k in range(3)], F.sum(odd).alias("_odd"),
        F.count("_x").alias("_values"), F.count(F.lit(1)).alias("_rows"))
    digit = [F.sum(F.when(F.col("_bin") == k, F.col("_l0")).when(F.col("_bin") == k + 1, F.col("_l1"))
                   .when(F.col("_bin") == k + 2, F.col("_l2")).otherwise(F.lit(0))) for k in BINS]
    out = bins.groupBy(*keys).agg(F.array(*digit).alias("_d"), F.sum("_odd").alias("_odd"),
                                  F.sum("_values").alias("_values"), F.sum("_rows").alias("_rows"))
    total = F.when(F.col("_values") == 0, F.lit(None).cast("double")).otherwise(
        F.coalesce("_odd", _rounded(F.col("_d"))))
    more = [F.col(c).alias(n) for c, n in (("_rows", rows), ("_values", values)) if n]
    # a row per group: the exchange keeps the rounding from being copied into whatever reads it several times
    return out.select(*keys, total.alias(name), *more).hint("rebalance", *keys)
