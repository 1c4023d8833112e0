"""Connected components of a link table that is never gathered in one place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, join_by_key, width

#: Links that a task works on at least, so that a few links don't make a thousand small files.
LINKS_A_TASK = 50_000


def stars(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Links (smallest node, other) that connect what the given links connect, one for each other node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        least = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], least)
        np.minimum.at(label, label[y], least)
        label = label[label]
        if np.array_equal(label, before):
            break
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[label[other]], nodes[other]], 1)


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links of a small table at once: every node and its root."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    u, v = (np.concatenate([np.zeros(0, np.int64), *side]) for side in zip(*held, strict=True)) if held else (np.zeros(0, np.int64),) * 2
    found = stars(u, v)
    roots = np.unique(found[:, 0])
    yield pa.record_batch([pa.array(np.r_[found[:, 1], roots]), pa.array(np.r_[found[:, 0], roots])], names=["node", "root"])


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(2**31)))).first())


def connected_components(links: DataFrame, a: str, b: str, at_once: int = LINKS_A_TASK) -> DataFrame:
    """node, root: every node of a link and the smallest node that it reaches.

    Alternating large-star and small-star steps until nothing changes, about the logarithm
    of the number of links. Each step is aggregations with map-side combine and equi-joins
    in which the nodes with very many links are broadcast; its result is checkpointed.
    Steps never add links, and once no more than `at_once` are left, those of one task (under
    a megabyte), that task finds the roots.
    Nulls and links from a node to itself are left out. No links: no rows.
    """
    most = width(links.sparkSession)
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    edges = durable(links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v").distinct())
    state = _state(edges)
    while state[0] > at_once:
        tasks = min(most, 1 + state[0] // LINKS_A_TASK)
        edges = edges.coalesce(tasks)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n")).coalesce(tasks)
        # Large star: neighbours above u go to the smallest of u and its neighbours.
        large = join_by_key(both, least, "u", "n", 2 * state[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(tasks)
        # Small star: u and its smaller neighbours go to the smallest of those.
        large = durable(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).coalesce(tasks)
        pairs = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        edges = durable(join_by_key(large, least, "u", "n", state[0]).select(pairs.alias("e")).select("e.u", "e.v").where("u > v").distinct().coalesce(tasks))
        before, state = state, _state(edges)
        if state == before:
            break
    if state[0] <= at_once:
        return edges.coalesce(1).mapInArrow(_in_one_task, "node long, root long")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
