"""Exact deduplication by two-pass Bloom filtering, in DataFrame operations only.

Pass one counts 64-bit hashes of the texts' digests, combined before they shuffle, and makes
a Bloom filter of those that two or more rows have. Pass two probes it: a row that the filter
knows is possibly repeated and joins the shuffle, every other row passes straight through.
False hits only cost a shuffle of that row, as groups are then formed by the SHA-256 of the
text. Texts themselves are never shuffled to find groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import MOST_PAGES, Bloom, without
from .common import durable, fold_ascii, join_by_key


def digests(docs: DataFrame, text: str = "text") -> Column:
    """SHA-256 in lowercase hex of the ASCII-folded text (null: empty)."""
    return F.sha2(fold_ascii(docs[text]), 256)


def repeated(hashed: DataFrame, digest: str) -> DataFrame:
    """`__key`: the hashes of digests that two or more rows have.

    Counts are combined before the shuffle, so a text of a third of all rows is one number
    from each task; a text that no other row of its task has is one number of 8 bytes.
    """
    return hashed.groupBy(F.xxhash64(digest).alias("__key")).count().where("count > 1").select("__key")


def _judged(hashed: DataFrame, most_pages: int) -> DataFrame:
    """Adds `__suspect` to rows with text_sha256: whether another row possibly has the same."""
    keyed = hashed.withColumn("__key", F.xxhash64("text_sha256"))
    return Bloom(durable(repeated(hashed, "text_sha256")), "__key", most_pages).mark(keyed, "__key").drop("__key")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most_pages: int = MOST_PAGES) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row
    with the largest doc_id of a group stays (a null id only if all ids are null). Rows
    that repeat a doc_id and its text count in group_size and are each marked kept if that
    id stays; `exact_dedup` returns such a row once. Empty table: no rows. Other columns
    are not read.
    """
    hashed = durable(docs.select(F.col(doc_id).alias("doc_id"), digests(docs, text).alias("text_sha256")))
    judged = _judged(hashed, most_pages)
    straight = judged.where(~F.col("__suspect")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    suspects = durable(judged.where("__suspect").drop("__suspect"))
    groups = durable(suspects.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    grouped = join_by_key(suspects, groups, "text_sha256", "group_size", hashed.count()).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
    return straight.unionByName(grouped)


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most_pages: int = MOST_PAGES) -> DataFrame:
    """The rows of `docs`, with all their columns, less those whose text a row with a larger doc_id has too.

    Of equal texts under one id, also ones that differ in case, one stays. Each text is
    digested once; the rows that go are then known by their id and a hash of the text, and
    only rows that a filter over those knows are shuffled.
    """
    own, row = docs[doc_id], F.xxhash64(docs[doc_id], docs[text])
    hashed = durable(docs.select(own.alias("__id"), row.alias("__row"), digests(docs, text).alias("text_sha256")))
    suspects = durable(_judged(hashed, most_pages).where("__suspect").drop("__suspect"))
    groups = durable(
        suspects.groupBy("text_sha256").agg(F.max(F.struct("__id", "__row")).alias("__stays"), F.count(F.lit(1)).alias("__size")).where("__size > 1")
    )
    met = durable(join_by_key(suspects, groups, "text_sha256", "__size", hashed.count()).withColumn(
        "__kept", F.col("__id").eqNullSafe(F.col("__stays.__id")) & (F.col("__row") == F.col("__stays.__row"))
    ))
    goes = met.where(~F.col("__kept")).select("__id", "__row").distinct()
    once = met.where("__kept").groupBy("__id", "__row").count().where("count > 1").select("__id", "__row")
    return without(docs, own, row, goes, once, most_pages)
