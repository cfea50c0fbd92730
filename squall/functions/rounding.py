"""Rounded means by whole numbers, the same on every engine.

A mean of binary fractions depends on the order of its sum, and whether
``x.xx5`` is rounded up on its last bits.  Here the values are scaled to whole
numbers first, their sum is exact, and the quotient is rounded half away from
zero in whole numbers as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_mean(col: str, places: int, scale: int = 6) -> Column:
    """Aggregate: the mean of ``col``, whose values have at most ``scale``
    decimals, rounded to ``places``; null without values."""
    total = F.sum(F.round(F.col(col) * 10 ** scale).cast("decimal(38,0)"))
    return rounded_ratio(total, F.count(col), places, scale)


def exact_share(condition: Column, places: int) -> Column:
    """Aggregate: the share of rows that meet ``condition``."""
    return rounded_ratio(F.count_if(condition).cast("decimal(38,0)"), F.count(F.lit(1)), places, 0)


def rounded_ratio(total: Column, n: Column, places: int, scale: int) -> Column:
    """total / (n * 10^scale), half away from zero at ``places``."""
    up, down = 10 ** max(places - scale, 0), 10 ** max(scale - places, 0)
    n = n.cast("decimal(20,0)") * F.lit(down).cast("decimal(18,0)")
    doubled = F.abs(total) * F.lit(2 * up).cast("decimal(18,0)") + n
    whole = F.call_function("div", doubled, F.nullif(n * F.lit(2).cast("decimal(1,0)"), F.lit(0).cast("decimal(1,0)")))
    return F.when(total < 0, -whole).otherwise(whole) / F.lit(float(10 ** places))


def sql_rounded_ratio(total: str, n: str, places: int, scale: int) -> str:
    """The same in DuckDB, for whole-number expressions."""
    up, down = 10 ** max(places - scale, 0), 10 ** max(scale - places, 0)
    whole = f"((abs({total}) * {2 * up} + ({n}) * {down}) // nullif(({n}) * {2 * down}, 0))"
    return f"(CASE WHEN ({total}) < 0 THEN -{whole} ELSE {whole} END / {float(10 ** places)})"
