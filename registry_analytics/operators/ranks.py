"""Exact order statistics by radix selection.

A value becomes a 64-bit key of the same order. Level by level, the next 14 bits (at most) of the keys that
share a wanted rank's prefix are counted, and the rank's digit is read off those counts. What moves is one
count per digit, rank and task, at most 16,384 a rank: no value is shuffled or sorted, however often one
occurs. Like ``DataFrame.approxQuantile``, the functions run their jobs when called.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGIT_BITS = 14


def order_key(c: Column, kind: T.DataType) -> Column:
    """A bigint in the order of ``c``, and equal only for equal values.

    Integers are their own key, decimals of up to 18 digits their unscaled value. A double's key is its
    exponent and the 52 bits of its mantissa, negated for a negative number; NaN comes last.
    """
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("bigint")
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (c * F.lit(10 ** kind.scale).cast(T.DecimalType(kind.scale + 1, 0))).cast("bigint")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        size = F.abs(c.cast("double"))
        guess = F.floor(F.log2(size)).cast("int")  # rounding may miss the exponent by one
        power = F.pow(F.lit(2.0), guess.cast("double"))
        exponent = guess + F.when(size < power, -1).when(size / 2 >= power, 1).otherwise(0)
        # numbers under 2 ** -1022 share the exponent of the smallest normal ones
        exponent = F.greatest(exponent, F.lit(-1022))
        scaled = size / F.pow(F.lit(2.0), exponent.cast("double"))  # exact: in [0, 2)
        key = (exponent + F.lit(1022)).cast("bigint") * F.lit(1 << 52) + F.floor(scaled * F.lit(float(1 << 52))).cast("bigint")
        top = F.lit((1 << 63) - 1)
        signed = F.when(F.isnan(c), top).when(size == float("inf"), F.when(c > 0, top - 1).otherwise(1 - top))
        return signed.when(size == 0, F.lit(0).cast("bigint")).when(c < 0, -key).otherwise(key)
    raise TypeError(f"no order key for {kind.simpleString()}")


def percentiles_disc(df: DataFrame, value_col: str, qs: Sequence[float], positive_only: bool = False) -> list[Any]:
    """Exact discrete percentiles: for each ``q`` the smallest value whose share of rows at or below it reaches ``q``.

    One pass finds the range of the keys; then there is a pass per 14 bits of that range, two for amounts
    up to two million with cents. NULLs are left out; without rows every percentile is None.
    """
    x = F.col(value_col)
    key = order_key(x, df.schema[value_col].dataType)
    keys = df.filter(x > 0 if positive_only else x.isNotNull()).select(x.alias("value"), key.alias("key"))
    n, low, high = keys.agg(F.count(F.lit(1)), F.min("key"), F.max("key")).first()
    if not n:
        return [None] * len(qs)
    bits = ((low ^ high) & (1 << 64) - 1).bit_length()  # all keys agree in the bits above
    levels = max(1, -(-bits // DIGIT_BITS))
    ranks = [max(math.ceil(q * n), 1) for q in qs]  # among the keys with the percentile's prefix, at first all
    prefixes, values = [0] * len(qs), [None] * len(qs)
    for level in range(levels):
        shift, wide = bits * (levels - 1 - level) // levels, bits * (levels - level) // levels
        wanted = F.shiftright("key", wide).isin(sorted(set(prefixes))) if level else F.lit(True)
        counted = keys.filter(wanted).groupBy(F.shiftright("key", shift).alias("digits")).agg(F.count(F.lit(1)), F.min("value"))
        counts = sorted(map(tuple, counted.collect()))
        for p, rank in enumerate(ranks):
            before = 0
            for digits, c, value in counts:
                if level == 0 or digits >> (wide - shift) == prefixes[p]:
                    if rank <= before + c:
                        ranks[p], prefixes[p], values[p] = rank - before, digits, value  # in the last level the digits are one key
                        break
                    before += c
    return values
