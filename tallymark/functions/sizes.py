"""Storage sizes: bytes to text, text to whole kB or GB."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Powers of 1024 each unit stands for.
UNIT_POWERS = [("kB", 1), ("MB", 2), ("GB", 3), ("TB", 4)]
BYTES_LIMIT = 10 * 1024
HALF_UNIT_LIMIT = 2 * BYTES_LIMIT - 1


def _amount(size: Column) -> Column:
    return F.regexp_extract(size, r"^\s*(-?\d+)", 1).try_cast("long")


def _scaled(amount: Column, power: int) -> Column:
    """Amount times 1024**power, floored for a negative power."""
    if power >= 0:
        return F.shiftleft(amount, 10 * power)
    return F.shiftright(amount, -10 * power)


def _in_unit(size: Column, target_power: int) -> Column:
    amount = _amount(size)
    result = _scaled(amount, -target_power)
    for unit, power in reversed(UNIT_POWERS):
        result = F.when(size.contains(unit), _scaled(amount, power - target_power)).otherwise(result)
    return result


def size_in_kb(size: Column) -> Column:
    """Size text as whole kB, floored."""
    return _in_unit(size, 1)


def size_in_gb(size: Column) -> Column:
    """Size text as whole GB, floored."""
    return _in_unit(size, 3)


def pretty_size(size_bytes: Column) -> Column:
    """Bytes as text, rounded half away from zero in the first unit that fits."""
    value = size_bytes.cast("long")

    def rounded(halves: Column, unit: str) -> Column:
        away = F.when(halves < 0, -1).otherwise(1)
        doubled = halves + away
        towards_zero = F.signum(doubled).cast("long") * F.shiftright(F.abs(doubled), 1)
        return F.concat(towards_zero.cast("string"), F.lit(f" {unit}"))

    def halves(power: int) -> Column:
        return F.shiftright(value, 10 * power - 1)

    result = rounded(halves(4), "TB")
    for unit, power in reversed(UNIT_POWERS[:3]):
        result = F.when(F.abs(halves(power)) < HALF_UNIT_LIMIT, rounded(halves(power), unit)).otherwise(result)
    return F.when(
        F.abs(value) < BYTES_LIMIT, F.concat(value.cast("string"), F.lit(" bytes"))
    ).otherwise(result)
