"""Which shards can hold a query's terms, by bitmaps of n-grams made at ingest.

Terms match as substrings, so a chunk that holds a term holds all its n-grams. Each shard has a
bitmap of the n-grams of its normalised text, in pages; a search reads only the
pages that its terms' n-grams lie in, and scores only shards that may hold enough terms of
one of its queries. What is skipped can't match, so hits don't change.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import query_terms
from .scoring import LEAST_TERMS, unique_queries

#: Bits of a shard's bitmap, bits of a page (as Spark's bitmap functions have them), and characters of the n-grams.
BITS, PAGE, GRAMS = 1 << 21, 32768, (3, 4)


#: Characters that are hashed at a time, rows whose texts are Python strings at a time, and bitmaps that a task holds (of BITS / 8 bytes).
STRETCH, ROWS, OPEN = 1 << 16, 256, 64


def _hashed(text: str) -> Iterator[np.ndarray]:
    """The bits of a text's n-grams, stretch by stretch, repeats included."""
    for low in range(0, len(text), STRETCH):
        # A stretch reaches into the next one by as much as its last n-grams do.
        points = np.frombuffer(text[low : low + STRETCH + max(GRAMS) - 1].encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        for n in GRAMS:
            size = min(STRETCH, len(points) - n + 1)
            if size > 0:
                mixed = np.full(size, n, np.uint64)
                for k in range(n):
                    mixed = (mixed ^ points[k : size + k]) * np.uint64(0x9E3779B97F4A7C15)
                    mixed ^= mixed >> np.uint64(29)
                yield (mixed % np.uint64(BITS)).astype(np.int64)


def places(text: str) -> np.ndarray:
    """The bits of a text's n-grams, each once. A text shorter than an n-gram has none of it."""
    return np.unique(np.concatenate([np.zeros(0, np.int64), *_hashed(text)]))


def signatures(chunks: DataFrame, name: str = "name", content: str = "content_norm") -> DataFrame:
    """name, page, bits of the shards named in a column of `chunks`, made where the chunks are and combined by shard and page.

    A task holds at most OPEN bitmaps, those of the shards that it met last, and hashes a stretch of text at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                names = part.column(0)
                for own in names.unique().to_pylist():
                    bits = shards[own] = shards.pop(own) if own in shards else np.zeros(BITS // 8, np.uint8)
                    texts = part.column(1).filter(pa.compute.equal(names, own)).to_pylist()
                    # A line feed between chunks; the n-grams across it only set bits that needn't be.
                    for found in _hashed("\n".join(t or "" for t in texts)):
                        np.bitwise_or.at(bits, found >> 3, np.left_shift(1, found & 7).astype(np.uint8))
                    if len(shards) > OPEN:
                        yield _pages(first := next(iter(shards)), shards.pop(first))
        for own, bits in shards.items():
            yield _pages(own, bits)

    made = chunks.select(name, content).mapInArrow(run, "name string, page int, bits binary")
    return made.groupBy("name", "page").agg(F.bitmap_or_agg("bits").alias("bits"))


def _pages(name: str, bits: np.ndarray) -> pa.RecordBatch:
    pages = bits.reshape(-1, PAGE // 8)
    own = np.flatnonzero(pages.any(1))
    packed = [pages[p].tobytes() for p in own]
    return pa.record_batch([pa.array([name] * len(own), pa.string()), pa.array(own, pa.int32()), pa.array(packed, pa.binary())], names=["name", "page", "bits"])


def possible(signed: DataFrame, queries: str | list) -> DataFrame:
    """name of each shard that may hold a chunk with enough terms of one of the queries."""
    counts = [Counter(query_terms(q)) for q in unique_queries(queries)]
    grams = {t: places(t).tolist() for own in counts for t in own}
    needed = sorted({g for own in grams.values() for g in own})
    asked = [[{"n": n, "grams": grams[t]} for t, n in own.items()] for own in counts if own]
    if not asked:
        return signed.where("false").select("name")
    wanted = signed.sparkSession.createDataFrame([(g // PAGE, g) for g in needed], "page int, gram int")  # a row an n-gram of the queries
    byte = F.substring("bits", F.shiftright(F.col("gram") % PAGE, 3) + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.col("gram") % 8) == 1
    pages = signed.where(F.col("page").isin(sorted({g // PAGE for g in needed})))
    found = pages.join(F.broadcast(wanted), "page").groupBy("name").agg(F.collect_set(F.when(is_set, F.col("gram"))).alias("found"))
    all_queries = F.from_json(F.lit(json.dumps(asked)), "array<array<struct<n:int,grams:array<int>>>>")
    held = lambda x: F.when(F.forall(x["grams"], lambda g: F.array_contains("found", g)), x["n"]).otherwise(0)
    enough = F.exists(all_queries, lambda q: F.aggregate(q, F.lit(0), lambda sum_, x: sum_ + held(x)) >= LEAST_TERMS)
    # Terms too short for an n-gram are held by every shard.
    names = signed.select("name").distinct().join(found, "name", "left").withColumn("found", F.coalesce("found", F.array().cast("array<int>")))
    return names.where(enough).select("name")
