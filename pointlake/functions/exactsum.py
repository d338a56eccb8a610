"""Sums of doubles that do not depend on the order of the rows.

A double is a whole number times a power of two. Values are dealt by their exponent into bands
of BAND_BITS; within a band every value is a whole number of the band's unit, cut into three digits
of 20 bits that are added as whole numbers. Whole numbers add up alike in any order and over any
tasks, so the digits of a band are exact, whatever the rows were; a group has at most some 260
bands. The digits are joined once for each group, largest band first, with the rounding error of
every step carried along, so equal digits give equal bits.

The digits are also a state that can be stored and added to: see ``streaming.partials``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlake.functions.columns import ref

BAND_BITS = 8
DIGIT_BITS = 20
LOWEST, HIGHEST = -128, 127  # bands of all doubles
SPARE_BITS = 54  # a value of a band is a whole number of 2^(band * 8 - 54)
BAND = "_band"
DIGITS = ("_low", "_mid", "_high")
# Sum of infinities and NaN, which no order changes; and the number of values.
SPECIAL, COUNT = "_special", "_count"
STATE = (*DIGITS, SPECIAL, COUNT)


def _scaled(value: Column, exponent: Column) -> Column:
    """``value * 2^exponent`` in two exact steps, as either power alone may be out of range."""
    first = F.floor(exponent / 2)
    return value * F.pow(F.lit(2.0), first) * F.pow(F.lit(2.0), exponent - first)


def with_digits(df: DataFrame, value: Column) -> DataFrame:
    """Adds the band of a value and its digits, zero for NULL."""
    number = value.cast("double")
    special = F.isnan(number) | (F.abs(number) == float("inf"))
    finite = F.when(F.coalesce(special, F.lit(True)), F.lit(0.0)).otherwise(number)
    band = F.coalesce(F.greatest(F.floor(F.log2(F.abs(finite)) / BAND_BITS), F.lit(LOWEST)), F.lit(LOWEST)).cast("int")
    df = df.withColumns({
        BAND: band, "_finite": finite, SPECIAL: F.when(special, number), COUNT: number.isNotNull().cast("bigint"),
    })
    whole = _scaled(F.col("_finite"), F.lit(SPARE_BITS) - F.col(BAND) * BAND_BITS).cast("bigint")
    df = df.withColumn("_whole", whole)
    size, mask = F.abs("_whole"), F.lit((1 << DIGIT_BITS) - 1).cast("bigint")
    sign = F.when(F.col("_whole") < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    digits = {
        DIGITS[0]: sign * size.bitwiseAND(mask),
        DIGITS[1]: sign * F.shiftright(size, DIGIT_BITS).bitwiseAND(mask),
        DIGITS[2]: sign * F.shiftright(size, 2 * DIGIT_BITS),
    }
    return df.withColumns(digits).drop("_finite", "_whole")


def band_sums(df: DataFrame, value: Column, by: Sequence[Column], extra: Sequence[Column] = ()) -> DataFrame:
    """The sums of every group and band; tasks add up their own rows before the shuffle."""
    sums = [F.sum(c).alias(c) for c in STATE]
    return with_digits(df, value).groupBy(*by, BAND).agg(*sums, *extra)


def merged_bands(sums: DataFrame, by: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """``<by>, sum, mean, count`` and ``extra`` from sums of bands; a group's bands meet in one row."""
    band = F.struct(F.col(BAND).alias("band"), *[F.col(d).alias(d) for d in DIGITS])
    groups = sums.groupBy(*[ref(c) for c in by]).agg(
        F.sort_array(F.collect_list(band), asc=False).alias("_bands"),
        F.sum(SPECIAL).alias(SPECIAL), F.sum(COUNT).alias("count"), *extra,
    )
    # Sums near the largest double are formed smaller; there, the smallest digits do not matter.
    shrink = F.when(F.get("_bands", F.lit(0))["band"] > HIGHEST - 20, F.lit(-160)).otherwise(F.lit(0))
    terms = F.flatten(
        F.transform(
            "_bands",
            lambda b: F.array(*[
                _scaled(b[name].cast("double"), b["band"] * BAND_BITS - SPARE_BITS + DIGIT_BITS * place + F.col("_shrink"))
                for place, name in reversed(list(enumerate(DIGITS)))
            ]),
        )
    )

    def add(state: Column, term: Column) -> Column:
        total = state["total"] + term
        lost = F.when(
            F.abs(state["total"]) >= F.abs(term), (state["total"] - total) + term
        ).otherwise((term - total) + state["total"])
        return F.struct(total.alias("total"), (state["lost"] + lost).alias("lost"))

    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("lost"))
    groups = groups.withColumn("_shrink", shrink).withColumn("_terms", terms)
    groups = groups.withColumn("_sum", F.aggregate("_terms", start, add, lambda s: s["total"] + s["lost"]))
    some = F.col("count") > 0
    back = -F.col("_shrink")
    total = F.coalesce(SPECIAL, _scaled(F.col("_sum"), back))
    average = F.coalesce(SPECIAL, _scaled(F.col("_sum") / F.col("count"), back))
    kept = [c for c in groups.columns if c not in (*by, "_bands", "_shrink", "_terms", "_sum", SPECIAL, "count")]
    return groups.select(
        *[ref(c) for c in by], F.when(some, total).alias("sum"), F.when(some, average).alias("mean"), "count",
        *[ref(c) for c in kept],
    )
