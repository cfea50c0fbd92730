"""Places in an order, and running totals along it, without one task that sees
a whole group.

``numbered`` deals rows by ranges of (group, order), so a group with a third
of all rows is spread over many tasks; a row's place is its place in its range
plus the group's rows in the ranges before.  ``running`` scans blocks of
bounded length and adds the totals of the blocks before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squall.llm.common import scratch_table

BLOCK = 4096


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, *, place: str = "idx") -> DataFrame:
    """``df`` with ``place``, each row's number (from 0) within its group.

    Rows equal in group and order are told apart by where they were read, so
    copies of one row are spread as well; ``df`` should be a table, since its
    ranges are found by reading it once more.  ``group`` columns must not be
    null; ``order`` columns may be, and nulls come first.
    """
    keys, cols = [*group, *order], df.columns
    placed = (df.withColumn("__tie", F.monotonically_increasing_id())
              .repartitionByRange(*keys, "__tie").sortWithinPartitions(*keys, "__tie").drop("__tie")
              .withColumn("__at", F.monotonically_increasing_id()))
    # the id is the range's number above 33 bits of the place in the range
    placed = scratch_table(placed, name).withColumn("__part", F.shiftright("__at", 33))
    sizes = placed.groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    # a row for each group in each range
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*group, "__part", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    return (placed.join(scratch_table(sizes, f"{name}-ranges"), [*group, "__part"])
            .withColumn(place, F.col("__at") + F.col("__shift")).select(*cols, place))


def running(df: DataFrame, group: Sequence[str], at: str, totals: dict[str, str], fold: Callable[[str], Column],
            join: Callable[[Column, Column], Column], block: int = BLOCK) -> DataFrame:
    """``df`` with, per name in ``totals``, that column folded over the rows
    of the group up to this one, in the order of ``at`` (0, 1, 2 ...).

    ``fold`` is an aggregate whose results ``join`` puts together (``F.sum``
    and addition).  A task holds ``block`` rows of a group, or a row for each
    full block of it.
    """
    cols = df.columns
    df = df.withColumn("__block", F.expr(f"`{at}` div {block}"))
    upto = Window.partitionBy(*group, "__block").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    inside = df.select(*cols, "__block", *[fold(c).over(upto).alias(n) for n, c in totals.items()])
    # only full blocks have any after them
    full = (df.groupBy(*group, "__block").agg(F.count(F.lit(1)).alias("__n"), *[fold(c).alias(f"__{n}") for n, c in totals.items()])
            .filter(F.col("__n") == block))
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)
    carry = full.select(*group, (F.col("__block") + 1).alias("__block"),
                        *[fold(f"__{n}").over(earlier).alias(f"__{n}") for n in totals])
    both = inside.join(carry, [*group, "__block"], "left")
    return both.select(*cols, *[F.when(F.col(f"__{n}").isNull(), F.col(n)).otherwise(join(F.col(n), F.col(f"__{n}"))).alias(n)
                                for n in totals])
