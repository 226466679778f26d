"""Number parsing and exact money sums."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanes of a whole number below 2**53, so that no lane's sum overflows before 2**44 rows.
_LANE_BITS = 18
_LANES = 3


def parse_double(value: Column) -> Column:
    return value.try_cast("double")


def parse_int(value: Column) -> Column:
    """Whole part of a number or numeric text; null if unreadable, NaN or out of range."""
    return value.try_cast("double").try_cast("int")


def round_int(value: Column) -> Column:
    """Nearest whole number, halves away from zero, as the warehouse casts a float to an int."""
    return F.round(value.try_cast("double"), 0).try_cast("int")


def exact_sum(value: Column, scale: int = 2) -> Column:
    """Sum of a double column holding money, the same whatever order the rows come in.

    A value that has at most `scale` decimals, as nearly all money has, is taken as a whole
    number of the smallest unit and added up in three long lanes, which overflow beyond 2**44
    rows and are hash-aggregated in generated code. Any other value is added as the decimal it
    is written as: with 16 decimals below 1e9, with 8 below 1e17, which is all that a double of
    that size holds. Only values from 1e17 on, infinities and NaN are added as doubles.
    """
    return exact_total({name: F.sum(part) for name, part in exact_parts(value, scale).items()}, scale)


def exact_parts(value: Column, scale: int = 2) -> dict[str, Column]:
    """What of each value is added up apart. Sums of these add up, over any groups of rows."""
    units = 10**scale
    minor = F.rint(value * F.lit(float(units)))
    size = F.abs(value)
    whole = (size < F.lit(float(2**53 // units))) & (minor / F.lit(float(units)) == value)
    number = F.when(whole, minor.cast("bigint"))
    mask = F.lit(2**_LANE_BITS - 1)
    lanes = [F.shiftright(number, i * _LANE_BITS) for i in range(_LANES)]
    lanes = [x if i == _LANES - 1 else x.bitwiseAND(mask) for i, x in enumerate(lanes)]
    return {f"lane{i}": x for i, x in enumerate(lanes)} | {
        "fine": F.when(~whole & (size < 1e9), value.cast("decimal(28,16)")),
        "large": F.when(~whole & (size >= 1e9) & (size < 1e17), value.cast("decimal(28,8)")),
        "rest": F.when((size >= 1e17) | F.isnan(value), value),
    }


def exact_total(sums: dict[str, Column], scale: int = 2) -> Column:
    """The total of the summed parts."""
    total = sum(
        sums[f"lane{i}"].cast("decimal(20,0)") * F.lit(Decimal(2 ** (i * _LANE_BITS)))
        for i in range(_LANES)
    )
    money = (total * F.lit(Decimal(1).scaleb(-scale))).cast("double")
    fine, large, rest = sums["fine"], sums["large"], sums["rest"]
    # Cents and finer values meet as decimals too, so their total is rounded once.
    both = F.try_add(
        (total * F.lit(Decimal(1).scaleb(-scale))).try_cast("decimal(36,16)"), fine
    ).cast("double")
    zero = F.lit(0.0)
    plain = F.coalesce(money, zero) + F.coalesce(fine.cast("double"), zero)
    fixed = F.when(fine.isNull(), money).otherwise(F.coalesce(both, plain))
    none = large.isNull() & rest.isNull()
    other = F.coalesce(large.cast("double"), zero) + F.coalesce(rest, zero)
    return F.when(none, fixed).otherwise(F.coalesce(fixed, zero) + other)


def exact_avg(value: Column, scale: int = 2) -> Column:
    return exact_sum(value, scale) / F.count(value)
