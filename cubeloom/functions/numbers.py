"""Measure parsing, lossless order-independent sums and guarded ratios.

Measures are DOUBLE at rest.  Summing doubles depends on the order of the rows,
so a value of at most four decimals is summed as BIGINT ten-thousandths, which
costs as much as a double sum, and any other value as DECIMAL, which costs
several times as much but is rare.  Nothing is rounded away and the result is
the same for every partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNITS_PER_ONE = 10_000
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def parse_number(col: Column) -> Column:
    """Text to DOUBLE, null for anything else (also 'nan', 'inf' and '12d')."""
    return F.when(col.rlike(NUMBER), col.try_cast("double"))


def number_column(df: DataFrame, name: str, default: float | None = None) -> Column:
    """A column as DOUBLE whatever its type, or a constant when it is absent."""
    if name not in df.columns:
        return F.lit(default).cast("double")
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_number(F.col(name))
    return F.col(name).cast("double")


PLAIN_BELOW = 1e7  # of values that BIGINT sums take: 90 million of the largest fit
NOISE = 2.0**-51  # of a double beside the decimal it stands for
REST = "decimal(38,14)"  # ten-thousandths with 14 more decimals
VALUE = "decimal(38,18)"  # values below 1e20; the shortest decimal that a double stands for
LIMB = 20  # bits of the low part of sums that may pass the BIGINT range


def _scaled(col: Column) -> Column:
    return F.rint(col * F.lit(float(UNITS_PER_ONE)))


def _is_plain(col: Column) -> Column:
    gap = F.abs(_scaled(col) / F.lit(float(UNITS_PER_ONE)) - col)
    return (F.abs(col) < F.lit(PLAIN_BELOW)) & (gap <= F.abs(col) * F.lit(NOISE))


def _is_finite(col: Column) -> Column:
    return F.abs(col) < F.lit(float("inf"))  # false for NaN, which is the largest value


def units(col: Column) -> Column:
    """Ten-thousandths as BIGINT; null for what :func:`rest` takes."""
    return F.when(_is_plain(col), _scaled(col).cast("bigint"))


def rest(col: Column) -> Column:
    """Values of more decimals or digits, as DECIMAL; not finite is an error."""
    error = F.raise_error(F.concat(F.lit("a measure is not finite: "), col.cast("string")))
    value = F.when(_is_finite(col), col.cast(VALUE)).otherwise(error.cast(VALUE))
    return F.when(~_is_plain(col), value)


def rests(columns: list[Column]) -> Column:
    """Array of :func:`rest` of several columns; null, and hardly any work, where all are plain."""
    odd = reduce(lambda a, b: a | b, [F.coalesce(~_is_plain(c), F.lit(False)) for c in columns])
    return F.when(odd, F.transform(F.array(*columns), rest))


def joined_units(plain: Column, others: Column) -> Column:
    """Ten-thousandths as DECIMAL from sums of both kinds; null if there is neither."""
    # moved by its point, as a product would have too many digits
    moved = F.concat(others.cast("string"), F.lit("e4")).cast(REST)
    both = F.coalesce(plain.cast(REST), F.lit(0)) + F.coalesce(moved, F.lit(0))
    return F.when(plain.isNotNull() | others.isNotNull(), both.cast(REST))


def exact_difference(plus: list[Column], minus: list[Column] | None = None) -> Column:
    """Of values of a row, as DOUBLE; null as soon as one part is."""
    minus = minus or []
    plain, value = F.lit(True), total([units(c) for c in plus])
    wide = total([joined_units(units(c), rest(c)) for c in plus])
    for col in minus:
        value = value - units(col)
        wide = wide - joined_units(units(col), rest(col))
    for col in (*plus, *minus):
        plain = plain & _is_plain(col)
    return F.when(plain, from_units(value)).otherwise(from_exact(wide))


def from_units(col: Column) -> Column:
    """BIGINT ten-thousandths as DOUBLE."""
    return col / F.lit(float(UNITS_PER_ONE))


def from_exact(col: Column) -> Column:
    """DECIMAL ten-thousandths as the nearest DOUBLE; their quotient has too many digits."""
    return F.concat(col.cast("string"), F.lit("e-4")).cast("double")


def unit_sum(col: Column) -> Column:
    """Lossless sum in ten-thousandths as DECIMAL, for groups of up to 90 million rows."""
    return joined_units(F.sum(units(col)), F.sum(rest(col)))


def sum_in_limbs(whole: Column) -> Column:
    """Sum of BIGINT values as DECIMAL by two BIGINT parts, for trillions of rows."""
    low = whole.bitwiseAND(F.lit((1 << LIMB) - 1))
    high = F.sum(F.shiftright(whole, LIMB)).cast("decimal(38,0)")
    return (high * F.lit(1 << LIMB) + F.sum(low)).cast("decimal(38,0)")


def wide_unit_sum(col: Column) -> Column:
    """Like :func:`unit_sum` for groups of any size, a whole table too."""
    return joined_units(sum_in_limbs(units(col)), F.sum(rest(col)))


def exact_sum(col: Column) -> Column:
    """Lossless sum as DOUBLE for groups of any size; infinite and NaN values count as such."""
    odd = F.sum(F.when(~_is_finite(col), col))
    finite = F.when(_is_finite(col), col)
    return F.when(odd.isNull(), from_exact(wide_unit_sum(finite))).otherwise(odd)


def safe_ratio(num: Column, den: Column) -> Column:
    """Null for a zero or missing denominator."""
    return F.when(den != 0, num / den)


def total(columns: list[Column]) -> Column:
    """Row-wise sum; null as soon as one part is null."""
    out = columns[0]
    for col in columns[1:]:
        out = out + col
    return out
