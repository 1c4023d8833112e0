"""Reproducible shuffle into shards: a Feistel permutation, with cycle walking, of row numbers.

Every row gets a gapless global number; a keyed permutation of 0..N-1 maps it to a place,
and shard = place mod shards, slot = place div shards. So shard and slot of any number are
computable alone (`place`), and the shuffle can be inverted (`number`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable
from .numbering import PRIME, STEP, running_total

ROUNDS = 6
#: Cycle-walking steps in the plan. The domain is under four times N, so a walk of W steps
#: goes on with probability under 0.75**W; a walk that would be longer fails loudly.
FIRST_STEPS, MORE_STEPS = 12, 400


def round_keys(seed: int) -> list[int]:
    """Keys of the rounds, from a seed."""
    keys, x = [], seed % PRIME or 1
    for _ in range(ROUNDS):
        x = x * STEP % PRIME
        keys.append(x)
    return keys


def half_bits(n: int) -> int:
    """Bits of each half of the domain for n rows."""
    return (max(n - 1, 1).bit_length() + 1) // 2


def _feistel(x: int, half: int, keys: list[int]) -> int:
    mask = (1 << half) - 1
    for k in keys:
        left, right = x >> half, x & mask
        y = (right + k) % PRIME
        y = y * y % PRIME * STEP % PRIME
        x = (right << half) | (left ^ ((y ^ (y >> 11)) & mask))
    return x


def place(number: int, n: int, seed: int = 1) -> int:
    """Place of a row number among n rows, as the plan computes it."""
    half, keys = half_bits(n), round_keys(seed)
    x = _feistel(number, half, keys)
    while x >= n:
        x = _feistel(x, half, keys)
    return x


def number(at: int, n: int, seed: int = 1) -> int:
    """Row number at a place: the inverse of `place`."""
    half, keys = half_bits(n), round_keys(seed)
    mask = (1 << half) - 1

    def back(x: int) -> int:
        for k in reversed(keys):
            right, left = x >> half, x & mask
            y = (right + k) % PRIME
            y = y * y % PRIME * STEP % PRIME
            x = ((left ^ ((y ^ (y >> 11)) & mask)) << half) | right
        return x

    x = back(at)
    while x >= n:
        x = back(x)
    return x


def _walk(x: str, steps: int, keys: str) -> str:
    """SQL: up to `steps` permutations of x, until it is under __total."""
    y = f"pmod((a & __mask) + k, {PRIME})"
    f = f"({y} * {y} % {PRIME} * {STEP} % {PRIME})"
    one = f"aggregate({keys}, c, (a, k) -> shiftleft(a & __mask, __half) | (shiftright(a, __half) ^ (({f} ^ shiftright({f}, 11)) & __mask)))"
    return f"aggregate(sequence(1, {steps}), {x}, (c, i) -> CASE WHEN i > 1 AND c < __total THEN c ELSE {one} END)"


def shard_rows(docs: DataFrame, shards: int = 40, seed: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law 'rows', shard, slot, grown_shard (null), row_number.

    The law is `rows`: shard counts differ by one at most, whatever the sizes or copies.
    Equal texts are dealt like any others. size is the text's UTF-8 bytes (null: none) plus
    16; text_crc32 is over those bytes. Repeated rows get a place each; a null doc_id is
    numbered among those of id 0's block. Empty table: no rows. Other columns aren't read.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
    )
    keys = "array(" + ", ".join(f"{k}L" for k in round_keys(seed)) + ")"
    numbered = running_total(slim, "doc_id", ["doc_id", "text_crc32", "size"]).withColumn(
        "__half", F.expr("cast((length(bin(greatest(__total - 1, 1))) + 1) div 2 AS int)")
    ).withColumn("__mask", F.expr("shiftleft(1L, __half) - 1"))
    walked = numbered.withColumn("__place", F.expr(_walk("__before", FIRST_STEPS, keys))).withColumn(
        "__place", F.expr(f"CASE WHEN __place < __total THEN __place ELSE {_walk('__place', MORE_STEPS, keys)} END")
    ).withColumn("__place", F.expr("CASE WHEN __place < __total THEN __place ELSE cast(raise_error('cycle walk too long') AS bigint) END"))
    return walked.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("__place") % shards).cast("int").alias("shard"),
        F.expr(f"__place div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("__before").alias("row_number"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40, seed: int = 1, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes `docs` as Parquet in folders __shard=0.., each file in slot order with the column __slot.

    Any ids may repeat or be null: rows of one id, size and checksum are numbered, and each
    takes a place of its own. Columns of `docs` named __shard or __slot are replaced. Empty
    table: a folder without rows.
    """
    crc = F.crc32(F.coalesce(docs[text], F.lit("")))
    names = [c for c in docs.columns if c.lower() not in ("__shard", "__slot")]
    alike = Window.partitionBy("__id", "__crc", "__size")
    size = (F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("long") + 16).alias("__size")
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs[doc_id].cast("long").alias("__id"), crc.alias("__crc"), size)
    plan = durable(shard_rows(docs, shards, seed, doc_id, text).select(
        F.col("doc_id").alias("__i"), F.col("text_crc32").alias("__c"), F.col("size").alias("__z"), F.col("shard").alias("__shard"), F.col("slot").alias("__slot"),
    ))
    same = Window.partitionBy("__i", "__c", "__z")
    plan = plan.withColumns({"__copies": F.count(F.lit(1)).over(same), "__copy": F.row_number().over(same.orderBy("__shard", "__slot"))})
    on = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__crc") == F.col("__c")) & (F.col("__size") == F.col("__z"))
    placed = rows.join(plan.where("__copies = 1"), on)
    # Only rows that are alike in all three are numbered, and so shuffled once more.
    several = rows.join(plan.where("__copies > 1 AND __copy = 1").select("__i", "__c", "__z"), on, "left_semi").withColumn("__copy", F.row_number().over(alike.orderBy(F.lit(0))))
    again = plan.where("__copies > 1").withColumnRenamed("__copy", "__n")
    placed = placed.select("row.*", "__shard", "__slot").unionByName(several.join(again, on & (F.col("__copy") == F.col("__n"))).select("row.*", "__shard", "__slot"))
    placed.repartition(shards, "__shard").sortWithinPartitions("__shard", "__slot").write.partitionBy("__shard").parquet(path)
