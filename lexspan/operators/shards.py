"""Byte-bounded shards by next-fit: exactly the sequential numbers, without a sequential task.

Rows are sorted by ranges. Inside a range, running sums give for every row the row that
begins the next shard if one begins with it, and doubling these links gives the shards from
there to the range's end and the bytes of the last one. Only rows that fit behind a shard left
open by earlier ranges can be the first to begin one, so what a range does is a short table:
by the bytes in the open shard, the shards that it begins and the bytes it leaves open. Tables of
sixteen ranges at a time are composed up a tree, and the open bytes and numbers are handed down it;
then each range numbers its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.durable import durable

#: Megabytes of a shard: default and least.
DEFAULT_MB, LEAST_MB = 20, 5
#: Ranges whose tables one task composes.
FAN_IN = 16


def shard_name(number: int) -> str:
    """File name of a shard, counted from 1."""
    return f"rag-index-{number:04d}.ndjson"


def line_bytes() -> Column:
    """UTF-8 bytes of a chunk's line of JSON, its line break included."""
    return (F.octet_length(F.to_json(F.struct("file", "folder", "content"))) + 1).cast("long")


class Effect:
    """What rows do to an open shard of u bytes (0: none is open): how many shards begin, and how many bytes the last one has.

    keys[e] are the bytes of the first e + 1 rows. With u bytes open the first row that doesn't
    fit begins a shard, and counts and outs say what follows from there; `total` is that of all rows.
    """

    def __init__(self, total: int, keys: np.ndarray, counts: np.ndarray, outs: np.ndarray, limit: int):
        self.total, self.keys, self.counts, self.outs, self.limit = total, keys, counts, outs, limit

    @classmethod
    def of(cls, sizes: np.ndarray, limit: int) -> Effect:
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        counts, last = chains(ends, sizes, limit)
        near = int(np.searchsorted(ends, limit - 1, side="right")) + 1  # rows that can be the first that doesn't fit
        return cls(total, ends[:near], counts[:near], (total - (ends - sizes)[last])[:near], limit)

    def apply(self, u: int) -> tuple[int, int]:
        """(shards that begin, bytes open at the end)."""
        if not len(self.keys):
            return 0, u
        e = int(np.searchsorted(self.keys, self.limit - u, side="right")) if u else 0
        return (int(self.counts[e]), int(self.outs[e])) if e < len(self.keys) else (0, u + self.total)

    def then(self, after: Effect) -> Effect:
        """This, and then that of the rows behind."""
        ends = [after.apply(int(u)) for u in self.outs]
        counts = self.counts + np.array([c for c, _ in ends], np.int64)
        outs = np.array([u for _, u in ends], np.int64)
        # Where all own rows fit, the first of the others that doesn't begins a shard.
        reached = self.total + np.r_[0, after.keys[:-1]] <= self.limit - 1 if len(after.keys) else np.zeros(0, bool)
        reached = reached if len(self.keys) else np.ones(len(after.keys), bool)
        return Effect(
            self.total + after.total, np.r_[self.keys, self.total + after.keys[reached]], np.r_[counts, after.counts[reached]], np.r_[outs, after.outs[reached]], self.limit
        )._short()

    def _short(self) -> Effect:
        """Without keys that make no difference to the next one."""
        if len(self.keys) < 2:
            return self
        same = (self.counts[1:] == self.counts[:-1]) & (self.outs[1:] == self.outs[:-1])
        kept = np.r_[~same, True]
        return Effect(self.total, self.keys[kept], self.counts[kept], self.outs[kept], self.limit)


def chains(ends: np.ndarray, sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row, if a shard begins with it: the shards from there on, and the row that begins the last of them."""
    n = len(ends)
    following = np.maximum(np.searchsorted(ends, ends - sizes + limit, side="right"), np.arange(1, n + 1))
    counts, last = np.ones(n + 1, np.int64), np.arange(n + 1)
    link = np.r_[following, n]  # row n is the end
    counts[n] = 0
    # Each link is replaced by two at once, until all lead to the end.
    while (link < n).any():
        inside = link < n
        last = np.where(inside, last[link], last)
        counts = counts + np.where(inside, counts[link], 0)
        link = link[link]
    return counts[:n], last[:n]


def starts(sizes: np.ndarray, limit: int, u: int) -> np.ndarray:
    """Which rows begin a shard when u bytes of one are open before them."""
    ends = np.cumsum(sizes)
    out = np.zeros(len(sizes), bool)
    at = int(np.searchsorted(ends, limit - u, side="right")) if u else 0
    while at < len(sizes):  # a step a shard
        out[at] = True
        at = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + limit, side="right")))
    return out


_EFFECT = "node long, total long, keys array<long>, counts array<long>, outs array<long>"


def _effect_row(node: int, e: Effect) -> pa.RecordBatch:
    lists = [pa.array([a.tolist()], pa.list_(pa.int64())) for a in (e.keys, e.counts, e.outs)]
    return pa.record_batch([pa.array([node], pa.int64()), pa.array([e.total], pa.int64()), *lists], names=["node", "total", "keys", "counts", "outs"])


def _effects(table: pa.Table, limit: int) -> list[tuple[int, Effect]]:
    numbers = lambda v: np.array(v, np.int64)
    rows = table.sort_by("node").to_pylist()
    return [(r["node"], Effect(r["total"], numbers(r["keys"]), numbers(r["counts"]), numbers(r["outs"]), limit)) for r in rows]


def _handed_down(effects: DataFrame, limit: int) -> DataFrame:
    """node, open, shards: the bytes of the open shard and the shards begun before each range."""
    levels = [durable(effects)]

    def compose(table: pa.Table) -> pa.Table:
        (node, whole), *rest = _effects(table, limit)
        for _, e in rest:
            whole = whole.then(e)
        return pa.Table.from_batches([_effect_row(node // FAN_IN, whole)])

    while (levels[-1].agg(F.max("node")).first()[0] or 0) >= FAN_IN:
        parents = levels[-1].groupBy(F.floor(F.col("node") / FAN_IN).alias("parent")).applyInArrow(compose, _EFFECT)
        levels.append(durable(parents))

    def hand(table: pa.Table) -> pa.Table:
        u, shards = table["open"][0].as_py(), table["shards"][0].as_py()
        out = []
        for node, e in _effects(table, limit):
            out.append((node, u, shards))
            begun, u = e.apply(u)
            shards += begun
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("node", "open", "shards"), zip(*out, strict=True), strict=True)})

    state = effects.sparkSession.createDataFrame([(0, 0, 0)], "parent long, open long, shards long")
    for level in reversed(levels):
        met = level.withColumn("parent", F.floor(F.col("node") / FAN_IN)).join(state, "parent")
        state = met.groupBy("parent").applyInArrow(hand, "node long, open long, shards long").select(F.col("node").alias("parent"), "open", "shards")
    return state.select(F.col("parent").alias("node"), "open", "shards")


def next_fit(rows: DataFrame, limit: int, order: list[str], size: str, ranges: int | None = None) -> DataFrame:
    """The columns of `rows` but `order`'s first, and shard_no: the shard, from 1, of each row in order.

    A new shard begins when a filled one would go over `limit` bytes; a longer row is a
    shard of its own. `order` should tell rows apart; equal rows are interchangeable. Its first column
    only sorts, so it may be one that Python can't take. A task holds the sizes of a range.
    """
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in rows.columns if c != order[0]]
    ranged = durable(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(*kept).withColumn("node", F.spark_partition_id().cast("long")))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sizes = None, []
        for batch in batches:
            if batch.num_rows:
                node = batch.column(0)[0].as_py()
                sizes.append(batch.column(1).to_numpy())
        if node is not None:
            yield _effect_row(node, Effect.of(np.concatenate(sizes).astype(np.int64), limit)._short())

    state = _handed_down(ranged.select("node", F.col(size).cast("long")).mapInArrow(describe, _EFFECT), limit)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        at, names = held[0].schema.get_field_index, held[0].schema.names
        sizes = np.concatenate([b.column(at(size)).to_numpy() for b in held]).astype(np.int64)
        begins = starts(sizes, limit, held[0].column(at("open"))[0].as_py())
        numbers = held[0].column(at("shards"))[0].as_py() + np.cumsum(begins)
        low = 0
        for b in held:
            yield pa.RecordBatch.from_arrays([*[b.column(at(c)) for c in names[:-3]], pa.array(numbers[low : low + b.num_rows], pa.int32())], names=[*names[:-3], "shard_no"])
            low += b.num_rows

    # A row a range is broadcast: open bytes and shards before it.
    known = ranged.join(F.broadcast(durable(state)), "node").select(*kept, "node", "open", "shards")
    return known.mapInArrow(number, ranged.select(*kept, F.lit(0).alias("shard_no")).schema)


def assign_shards(chunks: DataFrame, limit: int = DEFAULT_MB * 1024 * 1024, order: str = "doc_ord", ranges: int | None = None) -> DataFrame:
    """Adds line_bytes and shard_no (from 1) to chunks, in the order of `order`, file and chunk_no.

    Exactly the numbers of sequential next-fit. Only sizes are sorted; a file's shards come back
    as one row (its last shard and where new ones begin), which the chunks meet by file.
    """
    sized = chunks.withColumn("line_bytes", line_bytes())
    # Kept, as sorting by ranges reads its rows twice; they have no text.
    slim = durable(sized.select(F.col(order).alias("__order"), "file", "chunk_no", "line_bytes"))
    numbered = next_fit(slim, limit, ["__order", "file", "chunk_no", "line_bytes"], "line_bytes", ranges)
    firsts = numbered.groupBy("file", "shard_no").agg(F.min("chunk_no").alias("first"))
    files = firsts.groupBy("file").agg(F.max("shard_no").alias("__last"), F.collect_list("first").alias("__firsts"))
    later = F.size(F.filter("__firsts", lambda c: c > F.col("chunk_no")))
    return sized.join(files, "file").withColumn("shard_no", (F.col("__last") - later).cast("int")).select(*sized.columns, "shard_no")


def shard_descriptors(sharded: DataFrame) -> DataFrame:
    """file, chunks, bytes of each shard."""
    return sharded.groupBy("shard_no").agg(F.count(F.lit(1)).alias("chunks"), F.sum("line_bytes").alias("bytes")).select(
        F.format_string("rag-index-%04d.ndjson", "shard_no").alias("file"), "chunks", "bytes"
    )
