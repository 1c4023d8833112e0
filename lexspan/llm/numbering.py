"""Gapless numbers and running totals over a whole table, without a global sort.

Rows are dealt into a fixed number of blocks by an arithmetic mix of their id. A block's
total comes from a map-side combined aggregation, its offset from a running sum over the
few block totals, and a row's place from a window inside its block. No task sees more
than one group's block, however large a group is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Modulus and multiplier of the minimal-standard generator.
PRIME, STEP = 2147483647, 48271
BLOCKS = 4096


def block_of(key: Column, blocks: int = BLOCKS) -> Column:
    """Block of an integer id (null: that of 0)."""
    small = F.pmod(F.coalesce(key.cast("long"), F.lit(0)), F.lit(PRIME))
    return (small * F.lit(STEP)) % F.lit(PRIME) % F.lit(blocks)


def running_total(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str | None = None,
    group: str | None = None,
    blocks: int = BLOCKS,
) -> DataFrame:
    """Adds `__before` (sum of `value` over the rows that precede, inside `group`) and `__total`.

    `value` None counts rows, so `__before` is then a row number from 0. The order is that
    of (block of `key`, then `order`). A null `group` is a group of its own. `order` should
    tell rows apart; rows equal in all of it are interchangeable. An empty table stays empty.
    """
    amount = F.lit(1).cast("long") if value is None else F.col(value).cast("long")
    dealt = df.withColumns({
        "__block": block_of(F.col(key), blocks),
        "__value": amount,
        "__group": F.lit("") if group is None else F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("null")),
    })
    whole = Window.partitionBy("__group")
    totals = (
        dealt.groupBy("__group", "__block").agg(F.sum("__value").alias("__sum"))
        .withColumns({
            "__offset": F.sum("__sum").over(whole.orderBy("__block")) - F.col("__sum"),
            "__total": F.sum("__sum").over(whole),
        })
        .drop("__sum")
    )
    inside = Window.partitionBy("__group", "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("__inside", F.sum("__value").over(inside) - F.col("__value"))
    return (
        placed.join(totals, ["__group", "__block"])
        .withColumn("__before", F.col("__offset") + F.col("__inside"))
        .drop("__group", "__block", "__value", "__inside", "__offset")
    )
