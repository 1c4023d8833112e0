"""Bloom filters as pages of bits: rows that a filter doesn't know pass straight, only the others shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable

#: Bits in a page, as bitmap_construct_agg makes them; pages a key's share fills; bits set for a key.
PAGE, BITS_A_KEY, PROBES = 32768, 16, 3
#: Pages of one broadcast (32 MB). A larger filter is sent in several, each of which rows meet in turn, so rows never shuffle.
MOST_PAGES = 8192


def _page(key: Column, pages: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(pages))


def _bits(key: Column) -> list[Column]:
    """The places of a key's bits, fifteen bits of a hash each."""
    spread = F.xxhash64(key, F.lit(2))
    return [F.shiftrightunsigned(spread, 15 * k).bitwiseAND(F.lit(PAGE - 1)) for k in range(PROBES)]


class Bloom:
    """A filter over the 64-bit keys of a table, at 2 bytes a key; about one unknown key in two hundred seems known.

    The table is read twice, so it should be durable.
    """

    def __init__(self, keys: DataFrame, key: str, most_pages: int = MOST_PAGES):
        keys = keys.select(F.col(key).alias("__key")).where("__key IS NOT NULL")
        self.count = keys.count()
        self.pages = max(1, -(-self.count * BITS_A_KEY // PAGE))
        self.sent = max(1, most_pages)
        self.table = durable(
            keys.select(_page(F.col("__key"), self.pages).alias("__page"), F.explode(F.array(*_bits(F.col("__key")))).alias("__bit"))
            .groupBy("__page").agg(F.bitmap_construct_agg(F.col("__bit")).alias("__bits"))
        )

    def mark(self, rows: DataFrame, key: str, name: str = "__suspect") -> DataFrame:
        """Adds whether the filter knows the row's key. The rows aren't shuffled, however large the filter is.

        A row finds its page in one of the broadcasts; together they take 2 bytes a key of the filter in each executor.
        """
        met, parts = rows.withColumn("__page", _page(F.col(key), self.pages)), []
        for low in range(0, self.pages, self.sent):
            part = f"__bits{low}"
            slice_ = self.table.where((F.col("__page") >= low) & (F.col("__page") < low + self.sent)).withColumnRenamed("__bits", part)
            met = met.join(F.broadcast(slice_), "__page", "left")
            parts.append(part)
        met = met.withColumn("__bits", F.coalesce(*parts)).drop(*parts)
        known = F.lit(True)
        for bit in _bits(F.col(key)):
            byte = F.conv(F.hex(F.substring(F.col("__bits"), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            known = known & (F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1)
        return met.withColumn(name, F.coalesce(known, F.lit(False))).drop("__page", "__bits")


def without(docs: DataFrame, own: Column, row: Column, goes: DataFrame, once: DataFrame, most_pages: int = MOST_PAGES) -> DataFrame:
    """`docs`, with all their columns, less the rows whose id and hash are in `goes`; of those in `once` one stays.

    `own` and `row` are the id and a 64-bit hash of a row of `docs`; `goes` and `once` have them as
    __id and __row. Only rows that a filter over both tables knows are shuffled.
    """
    listed = durable(goes.select("__id", "__row", F.lit(1).alias("__least")).unionByName(once.select("__id", "__row", F.lit(0).alias("__least"))).groupBy("__id", "__row").agg(F.max("__least").alias("__goes")))
    tagged = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), own.alias("__own"), row.alias("__hash"))
    judged = Bloom(listed, "__row", most_pages).mark(tagged, "__hash")
    met = judged.where("__suspect").join(listed, F.col("__own").eqNullSafe(listed["__id"]) & (F.col("__hash") == listed["__row"]), "left")
    clean = met.where("__goes IS NULL").select("row.*")
    single = met.where("__goes = 0").dropDuplicates(["__own", "__hash"]).select("row.*")
    return judged.where(~F.col("__suspect")).select("row.*").unionByName(clean).unionByName(single)
