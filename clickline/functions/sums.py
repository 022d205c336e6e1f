"""Sums of doubles that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bin. Three bins hold the 53 bits of a double wherever they start.
_BITS = 26
#: Lowest first bin: its third unit, 2^-1066, is still above zero.
_LOWEST = -39
# Bins of the values that are no numbers.
_NAN, _PLUS, _MINUS = 1000, 1001, 1002


def sum_exactly(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """``keys`` and ``name``, the sum of ``column`` in each group, as with whole numbers of any length.

    Every value is cut, without rounding, into whole multiples of powers of 2^26, and those of one power are added as
    whole numbers, so large values that cancel out leave the small ones right. What is below 2^-1066 is left out. NaN and
    infinities give what adding them gives. Nulls do not count; a group of nulls only has a null sum.
    """
    value = F.col(column).cast("double")
    bins = df.select(*keys, F.explode_outer(F.when(value.isNotNull(), _pieces(value))).alias("_piece"))
    totals = bins.groupBy(*keys, F.col("_piece.bin").alias("_bin")).agg(
        # Some 10^11 rows fit a long; a decimal takes any number.
        F.sum(F.col("_piece.count").cast("decimal(20,0)")).alias("_total")
    )
    # At most a hundred bins a group.
    listed = F.array_sort(F.collect_list(F.when(F.col("_bin").isNotNull(), F.struct("_bin", "_total"))))
    return totals.groupBy(*keys).agg(listed.alias("_bins")).select(*keys, _folded(F.col("_bins")).alias(name))


def _pieces(value: Column) -> Column:
    """(bin, count) items of one value; the items add up to it."""

    def item(number: Column, count: Column) -> Column:
        return F.struct(number.cast("int").alias("bin"), count.cast("long").alias("count"))

    def unit(number: Column) -> Column:
        return F.pow(F.lit(2.0), number * _BITS)

    first = F.greatest(F.floor(F.floor(F.log2(F.abs(value))) / _BITS), F.lit(_LOWEST))
    items, rest = [], value
    for step in range(3):
        # Rounds towards zero.
        whole = F.signum(rest) * F.floor(F.abs(rest) / unit(first - step))
        items.append(item(first - step, whole))
        rest = rest - whole * unit(first - step)
    special = [(F.isnan(value), _NAN), (value == float("inf"), _PLUS), (value == float("-inf"), _MINUS), (value == 0, 0)]
    pieces = F.array(*items)
    for applies, number in special:
        pieces = F.when(applies, F.array(item(F.lit(number), F.lit(0 if number == 0 else 1)))).otherwise(pieces)
    return pieces


def _folded(bins: Column) -> Column:
    """The total, from the lowest bin up, with what each addition rounds off carried along."""

    def has(number: int) -> Column:
        return F.exists(bins, lambda b: b["_bin"] == number)

    def add(state: Column, b: Column) -> Column:
        term = b["_total"].cast("double") * F.pow(F.lit(2.0), b["_bin"] * _BITS)
        total = state["total"] + term
        lost = F.when(F.abs(state["total"]) >= F.abs(term), state["total"] - total + term).otherwise(term - total + state["total"])
        return F.struct(total.alias("total"), (state["lost"] + lost).alias("lost"))

    zero = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("lost"))
    numbers = F.filter(bins, lambda b: b["_bin"] < _NAN)
    finite = F.aggregate(numbers, zero, add, lambda state: state["total"] + state["lost"])
    return (
        F.when(F.size(bins) == 0, F.lit(None).cast("double"))
        .when(has(_NAN) | (has(_PLUS) & has(_MINUS)), F.lit(float("nan")))
        .when(has(_PLUS), F.lit(float("inf")))
        .when(has(_MINUS), F.lit(float("-inf")))
        .otherwise(finite)
    )
