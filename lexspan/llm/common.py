"""What several operators share: native word counts, names, joins by hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.durable import durable, shared_folder  # noqa: F401  the operators' own

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold_ascii(text: Column) -> Column:
    """A-Z to a-z; no other character changes. Null: empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Words of a text as a long; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(name: str, columns: list[str]) -> str:
    """`name`, or that with underscores behind it, if a column has it (case doesn't tell columns apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


#: A key is hot if it has more than this share of all rows; so there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001


def join_by_key(rows: DataFrame, small: DataFrame, key: str, count: str, total: int, how: str = "inner") -> DataFrame:
    """Joins rows to a table of one row a key, in which `count` has how many of the `total` rows have it.

    The hot keys, at most a thousand, are broadcast, so that their rows stay where they are;
    only the other rows shuffle, and no key of these has more than a thousandth of all.
    """
    hot = F.broadcast(small.where(F.col(count) > HOT_SHARE * total).withColumn("__hot", F.lit(True)))
    met = rows.join(hot, key, "left")
    rest = met.where("__hot IS NULL").select(*rows.columns).join(small, key, how)
    return met.where("__hot").drop("__hot").unionByName(rest)


def block_pairs(mine: Column, blocks: Column) -> Column:
    """Where a member of block `mine` goes if each two of the blocks meet: an array of (i, j, side), i <= j.

    side: 0 where the blocks are the same one, 1 for a member of i, 2 for a member of j.
    """
    return F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(
            F.least(other, mine).alias("i"), F.greatest(other, mine).alias("j"), F.when(other == mine, 0).when(mine < other, 1).otherwise(2).alias("side")
        ),
    )


def stretch(text: Column, characters: int, seed: Column, parts: int = 1) -> Column:
    """A text of at most so many characters whole, of a longer one `parts` stretches of as many in all, parted by line feeds.

    Each lies in its own part of the whole text, at a place that the seed's hash decides.
    """
    n, each = F.length(text), characters // parts
    cuts = []
    for k in range(parts):
        low, high = F.floor(n * k / parts), F.floor(n * (k + 1) / parts)
        at = low + F.pmod(F.xxhash64(seed, F.lit(k)), F.greatest(high - low - each + 1, F.lit(1)))
        cuts.append(F.substring(text, at.cast("int") + 1, F.lit(each)))
    return F.when(n <= characters, text).otherwise(F.concat_ws("\n", *cuts))


def first_rows(rows: DataFrame, by: str, order: list[str], most: int) -> DataFrame:
    """At most `most` rows of each value of `by`, the first by `order`; each task passes on no more than those."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return rows.withColumn("__rank", rank).where(F.col("__rank") <= most).drop("__rank")
