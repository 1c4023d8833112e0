"""Near-duplicate embeddings by Euclidean p-stable hashing.

Normalised vectors are projected on Gaussian directions and the projections quantised; a
bucket is a tuple of several. In each of multiple tables, vectors that share a bucket are
compared by their exact cosine, and a pair counts in the first table in which it meets.
Copies of a vector count as one class throughout. Pairs are counted and connected where
they are found and never listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_pairs, durable, join_by_key, width
from .components import connected_components, stars


#: Quantisation step, the chance to miss a pair at the threshold, members of a block of a crowded bucket.
STEP, MISS, BLOCK = 2.0, 0.001, 2048
#: Rows of a block compared with another at once, and rows whose tasks are worked off together.
STRIPE, HELD = 128, 20_000


def hit_rate(distance: float, step: float = STEP) -> float:
    """Chance that one quantised projection of two points at a distance agrees."""
    r = step / distance
    return erf(r / sqrt(2)) - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))


def tables_for(count: int, cosine: float, miss: float = MISS) -> tuple[int, int]:
    """(projections a bucket, tables) for so many vectors: more vectors, finer buckets and more tables."""
    k = max(6, min(24, round(log(max(count, 2)) / 0.9)))
    rate = hit_rate(sqrt(max(2 - 2 * cosine, 1e-6))) ** k
    return k, max(1, ceil(log(miss) / log(1 - rate)))


def _directions(dim: int, k: int, tables: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, k * tables)), rng.uniform(0, STEP, k * tables)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of arrays one behind the other, and the arrays' lengths."""
    return column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())


def _by_size(flat: np.ndarray, sizes: np.ndarray):
    """(rows, their vectors as a matrix) for each length of the vectors."""
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == size)
        yield own, flat[starts[own][:, None] + np.arange(size)]


def _hash(k: int, tables: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mix = np.random.default_rng([seed, 1]).integers(1, 2**62, k, dtype=np.int64) * 2 + 1
        for batch in batches:
            keys = np.zeros((batch.num_rows, tables), np.int64)
            for own, vectors in _by_size(*_lists(batch.column(1))) if batch.num_rows else ():
                dim = vectors.shape[1]
                directions, shifts = _directions(dim, k, tables, seed)
                for low in range(0, len(own), HELD):
                    part = slice(low, low + HELD)
                    cells = np.floor((_unit(vectors[part]) @ directions + shifts) / STEP).astype(np.int64).reshape(-1, tables, k)
                    keys[own[part]] = (cells * mix).sum(2) * np.int64(0x9E3779B97F4A7C1) + np.arange(tables) + dim * 1000
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * tables, keys.ravel())], names=["class", "keys"])

    return run


class _Task:
    """Rows of whole tasks, sorted by task, with vectors of one size; finds which link, and were not met in an earlier table."""

    def __init__(self, task: np.ndarray, own: np.ndarray, table: np.ndarray, side: np.ndarray, label: np.ndarray, copies: np.ndarray, keys: np.ndarray, vectors: np.ndarray, cosine: float):
        self.own, self.table, self.side, self.label, self.copies, self.keys, self.cosine = own, table, side, label, copies, keys, cosine
        self.units = _unit(vectors)
        self.bounds = np.flatnonzero(np.r_[True, task[1:] != task[:-1], True])

    def _new(self, p: np.ndarray, q: np.ndarray, table: int) -> np.ndarray:
        """Which pairs of rows are of two classes with one label that share no bucket of an earlier table."""
        new = (self.own[p] != self.own[q]) & (self.label[p] == self.label[q])
        for t in range(table):
            new &= self.keys[p, t] != self.keys[q, t]
        return new

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(class, rows linked to it, a class that it is connected with), a row for each class of a task that has links."""
        size = np.diff(self.bounds)
        p = self.bounds[:-1][size == 2]
        p = p[(self.side[p] == 0) | (self.side[p] != self.side[p + 1])]
        p = p[np.einsum("ij,ij->i", self.units[p], self.units[p + 1]) >= self.cosine]
        same = self.keys[p] == self.keys[p + 1]
        p = p[(self.own[p] != self.own[p + 1]) & (self.label[p] == self.label[p + 1]) & ~(same & (np.arange(same.shape[1]) < self.table[p][:, None])).any(1)]
        least = np.minimum(self.own[p], self.own[p + 1])
        yield np.r_[self.own[p], self.own[p + 1]], np.r_[self.copies[p + 1], self.copies[p]], np.r_[least, least]
        for low, n in zip(self.bounds[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
            yield self._crowd(np.arange(low, low + n))

    def _crowd(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table, none = int(self.table[at[0]]), np.zeros(0, np.int64)
        if any((self.keys[at, t] == self.keys[at[0], t]).all() for t in range(table)):
            return none, none, none  # an earlier table had them all in one bucket
        x, y = at[self.side[at] != 2], at[self.side[at] != 1]
        across = bool(len(x)) and self.side[x[0]] == 1
        linked, links = np.zeros(len(self.own), np.int64), [np.zeros((0, 2), np.int64)]
        for low in range(0, len(x), STRIPE):
            part = x[low : low + STRIPE]
            i, j = np.nonzero(self.units[part] @ self.units[y].T >= self.cosine)
            p, q = part[i], y[j]
            new = self._new(p, q, table)
            p, q = p[new], q[new]
            linked += np.bincount(p, self.copies[q], len(linked)).astype(np.int64)
            if across:
                linked += np.bincount(q, self.copies[p], len(linked)).astype(np.int64)
            if len(p):
                links.append(stars(self.own[p], self.own[q]))
        found = at[linked[at] > 0]
        own = self.own[found]
        links = np.concatenate(links)
        root = dict(stars(links[:, 0], links[:, 1])[:, ::-1].tolist()) if len(links) else {}
        return own, linked[found], np.array([root.get(c, c) for c in own.tolist()], np.int64)


def _compare(cosine: float, tables: int):
    """Rows (task, class, table, side, label, copies, keys, embedding) sorted by task. Whole tasks are held, about HELD rows of small ones at once."""
    schema = pa.schema([("class", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def found(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        task, own, table, side = (batch.column(k).to_numpy() for k in range(4))
        label = np.unique(batch.column(4).to_pylist(), return_inverse=True)[1]
        copies, keys = batch.column(5).to_numpy(), _lists(batch.column(6))[0].reshape(-1, tables)
        out = []
        for rows, vectors in _by_size(*_lists(batch.column(7))):
            out += _Task(task[rows], own[rows], table[rows], side[rows], label[rows], copies[rows], keys[rows], vectors, cosine).rows()
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        yield pa.record_batch([pa.array(c) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            task = batch.column(0).to_numpy()
            cut = int(np.flatnonzero(np.r_[True, task[1:] != task[:-1]])[-1])  # where the last task begins
            if cut == 0 and held and held[-1].column(0)[-1].as_py() == task[0]:
                held.append(batch)  # one task goes on
                continue
            held.append(batch.slice(0, cut))
            if sum(b.num_rows for b in held) >= HELD:
                yield from found(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from found(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return run


def embedding_links(classes: DataFrame, count: int, cosine: float = 0.98, seed: int = 4) -> DataFrame:
    """class, links, root: rows linked to a class in one task, and a class that these links connect it with.

    `classes` has class long, label, copies and embedding array<double>. A bucket of more
    than BLOCK members is a crowd. Those of its members that shared the same bucket of an earlier
    table, the most that did, have met there; only the rest are compared, with one another and
    with those. This goes by blocks, each pair of blocks a task of its own, so no task holds more
    than two blocks' vectors at a time. A task gives at most one row for each of its members.
    """
    k, tables = tables_for(count, cosine)
    hashed = durable(classes.select("class", "embedding").mapInArrow(_hash(k, tables, seed), "class long, keys array<long>"))
    known = classes.select("class", F.col("label").cast("string").alias("label"), "copies", "embedding").join(hashed, "class")
    tasks = _tasks(known.select("class", "label", "keys"), count * tables).join(known, "class")
    rows = tasks.select("task", "class", "table", "side", "label", "copies", "keys", "embedding")
    return rows.repartition(width(classes.sparkSession), "task").sortWithinPartitions("task").mapInArrow(_compare(cosine, tables), "class long, links long, root long")


def _tasks(known: DataFrame, total: int) -> DataFrame:
    """class, task, table, side: which members of buckets meet in which task. `known` has class, label and keys, `total` of them over all tables."""
    block = BLOCK
    slim = durable(known.select("class", "label", F.posexplode("keys").alias("table", "key")).select("class", "table", F.xxhash64("label", "table", "key").alias("bucket")))
    sizes = durable(slim.groupBy("bucket").count().where("count > 1"))
    alone = join_by_key(slim, sizes.where(F.col("count") <= block), "bucket", "count", total).select("class", F.xxhash64("bucket", F.lit(0), F.lit(0)).alias("task"), "table", F.lit(0).alias("side"))
    crowds = join_by_key(slim, sizes.where(F.col("count") > block), "bucket", "count", total).drop("count")
    members = durable(crowds.join(known.select("class", "keys"), "class"))
    # For each crowd the bucket of an earlier table that most of its members share; counts are combined before they shuffle.
    earlier = members.select("bucket", F.posexplode(F.slice("keys", F.lit(1), F.col("table"))).alias("t", "key")).groupBy("bucket", "t", "key").count()
    met = earlier.groupBy("bucket").agg(F.max(F.struct("count", "t", "key")).alias("met"))
    parts = durable(
        sizes.where(F.col("count") > block).join(met, "bucket", "left")
        .withColumns({"__met": F.coalesce("met.count", F.lit(0)), "__t": F.col("met.t"), "__key": F.col("met.key")})
        .select("bucket", "count", "__t", "__key", F.ceil((F.col("count") - F.col("__met")) / block).cast("int").alias("rest"), F.ceil(F.col("__met") / block).cast("int").alias("others"))
        .where("rest > 0")
    )
    own = join_by_key(members, parts, "bucket", "count", total).withColumn("__in", F.coalesce(F.get("keys", F.col("__t")) == F.col("__key"), F.lit(False)))
    own = own.withColumn("mine", F.pmod(F.xxhash64("class"), F.when(F.col("__in"), F.col("others")).otherwise(F.col("rest"))).cast("int"))
    place = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    upto = lambda n: F.filter(F.sequence(F.lit(0), n), lambda x: x < n)
    across = F.transform(upto(F.col("others")), lambda g: place(F.col("mine"), F.col("rest") + g, 1))
    theirs = F.transform(upto(F.col("rest")), lambda r: place(r, F.col("rest") + F.col("mine"), 2))
    dealt = own.select("class", "table", "bucket", F.explode(F.when(F.col("__in"), theirs).otherwise(F.concat(block_pairs(F.col("mine"), F.col("rest")), across))).alias("t"))
    return alone.unionByName(dealt.select("class", F.xxhash64("bucket", "t.i", "t.j").alias("task"), "table", F.col("t.side").alias("side")))


def embedding_dedup(vectors: DataFrame, cosine: float = 0.98, seed: int = 4, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept.

    Vectors link if labels are equal and not null, sizes are equal, and the cosine in double
    precision is at least `cosine`. A null or zero vector, one with null or non-finite
    components, and one with a null label link with nothing. n_links counts the other rows
    linked directly, component_id is the smallest vec_id reached, and kept marks the row
    whose id that is. Rows that repeat an id and a vector count as links of each other; a
    null id is never a component's. A pair at the threshold is missed with a chance of MISS,
    closer ones less often. Empty table: no rows. Other columns aren't read.
    """
    v = F.col("__vector")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.transform(F.col(embedding), lambda x: x.cast("double") + F.lit(0.0)).alias("__vector"))
    sound = F.coalesce(
        F.col("label").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0),
        F.lit(False),
    )
    rows = durable(rows.withColumn("__key", F.when(sound, F.sha2(F.to_json(F.struct("label", v.alias("v"))), 256))))
    classes = durable(
        rows.where("__key IS NOT NULL").groupBy("__key").agg(
            F.min("vec_id").alias("__least"), F.count(F.lit(1)).alias("__copies"), F.first("label").alias("label"), F.first(v).alias("embedding")
        ).withColumn("class", F.monotonically_increasing_id())
    )
    found = durable(embedding_links(classes.select("class", "label", F.col("__copies").alias("copies"), "embedding"), classes.count(), cosine, seed))
    roots = connected_components(found, "class", "root")
    known = classes.select("class", "__key", "__least", "__copies")
    degree = found.groupBy("class").agg(F.sum("links").alias("__others")).withColumnRenamed("class", "a")
    rooted = known.join(roots, known["class"] == roots["node"], "left").withColumn("__root", F.coalesce("root", "class")).drop("node", "root")
    least = rooted.groupBy("__root").agg(F.min("__least").alias("__component"))
    named = rooted.join(least, "__root").join(degree, rooted["class"] == degree["a"], "left").select(
        "__key", "__component", "__copies", (F.col("__copies") - 1 + F.coalesce("__others", F.lit(0))).alias("__links")
    )
    component = F.coalesce("__component", "vec_id")
    return join_by_key(rows, durable(named), "__key", "__copies", rows.count(), "left").select(
        "vec_id", F.coalesce("__links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")
    )
