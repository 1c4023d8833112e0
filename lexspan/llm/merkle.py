"""A Merkle manifest: a digest for every row, group and the whole table, and each row's proof.

A group's rows, in order, are the leaves of a tree whose nodes are the digests of runs of
three; the groups' roots are the leaves of one more tree. A group is worked on in aligned
blocks of 729 leaves, so that a group of any size is spread over many tasks. First every
block's root is made by a stack of digests (treehash), and the block roots are the leaves of
the next, much smaller table, up to the root. Then each block is traversed: beside the run
that the present leaf is in, every level of the block keeps a stack that makes the next run
from one new leaf a step, so that the authentication path moves on leaf by leaf with a few
digests a level. The path above a block is the same for all its leaves and is appended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, join_by_key, width

#: Nodes of a run; levels inside a block, which therefore has ARITY ** HEIGHT leaves at most.
ARITY, HEIGHT = 3, 6
BLOCK = ARITY**HEIGHT
#: Leaves that meet in one group of a task on average.
TOGETHER = 30_000

Path = list[tuple[int, list[str]]]  # from the leaf up: place in the run, and the others of the run


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Digest of a row's values, lowercase hex."""
    return F.sha2(F.concat(*map(encoded, values)), 256)


class TreeHash:
    """The nodes at `height` over the leaves pushed so far, from one open run a level."""

    def __init__(self, height: int):
        self.height, self.open = height, [[] for _ in range(height + 1)]

    def push(self, node: str) -> None:
        level = 0
        self.open[0].append(node)
        while level < self.height and len(self.open[level]) == ARITY:
            self._up(level)
            level += 1

    def _up(self, level: int) -> None:
        self.open[level + 1].append(digest("".join(self.open[level])))
        self.open[level] = []

    def close(self) -> list[str]:
        """The nodes at `height` when no more leaves come: short runs are complete then."""
        for level in range(self.height):
            if self.open[level]:
                self._up(level)
        return self.open[self.height]


def block_root(leaves: list[str], height: int) -> str:
    tree = TreeHash(height)
    for node in leaves:
        tree.push(node)
    return tree.close()[0]


def traverse(leaves: list[str], height: int) -> Iterator[Path]:
    """The path of each leaf in turn, up to the node at `height` over all of them."""
    spans = [ARITY ** (level + 1) for level in range(height)]
    runs = []
    for level, span in enumerate(spans):
        first = TreeHash(level)
        for node in leaves[:span]:
            first.push(node)
        runs.append(first.close())
    coming = [TreeHash(level) for level in range(height)]
    for i in range(len(leaves)):
        for level, span in enumerate(spans):
            if i and i % span == 0:
                runs[level], coming[level] = coming[level].close(), TreeHash(level)
            if i + span < len(leaves):
                coming[level].push(leaves[i + span])
        path = []
        for level, span in enumerate(spans):
            at = i % span // (span // ARITY)
            path.append((at, runs[level][:at] + runs[level][at + 1 :]))
        yield path


def fold(node: str, path: Path) -> str:
    """The root that a leaf and its path lead to."""
    for at, others in path:
        node = digest("".join([*others[:at], node, *others[at:]]))
    return node


def _text(path: Path) -> str:
    return "/".join(f"{at}{''.join(others)}" for at, others in path)


def _path(text: str) -> Path:
    return [(int(run[0]), [run[k : k + 64] for k in range(1, len(run), 64)]) for run in text.split("/") if run]


def folded(node: Column, proof: Column) -> Column:
    """`fold` as an expression, to check rows against a known root; `proof` is an array of runs as `merkle_manifest` gives."""

    def step(x: Column, run: Column) -> Column:
        cut = F.substring(run, 1, 1).cast("int") * 64
        return F.sha2(F.concat(F.substring(run, F.lit(2), cut), x, F.substring(run, cut + 2, F.length(run))), 256)

    return F.aggregate(proof, node, step)


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds __pos, a row's place (from 0) in its group by `order`, and __size, the rows of the group.

    Rows are sorted by ranges of (group, order), so a large group takes many tasks; a row's
    place in the whole table is that in its range and the rows of the ranges before, and the
    least of a group's places is where the group begins. `group` is not null.
    """
    spark = rows.sparkSession
    keys = [group, *order]
    ranged = durable(rows.repartitionByRange(width(spark), *keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id()))
    parts = ranged.withColumns({"__part": F.shiftright("__id", 33), "__at": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))})
    # One row a range.
    before = parts.groupBy("__part").count().select("__part", (F.sum("count").over(Window.orderBy("__part")) - F.col("count")).alias("__before"))
    placed = parts.join(F.broadcast(before), "__part").withColumn("__place", F.col("__before") + F.col("__at"))
    groups = durable(placed.groupBy(group).agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__size")))
    total = groups.agg(F.sum("__size")).first()[0] or 0
    met = join_by_key(placed, groups, group, "__size", total)
    return met.withColumn("__pos", F.col("__place") - F.col("__first")).drop("__id", "__part", "__at", "__before", "__place", "__first")


def _height(size: Column) -> Column:
    """Levels above the leaves of a tree with so many of them."""
    return F.size(F.filter(F.array(*[F.lit(ARITY**k) for k in range(40)]), lambda p: p < size))


def _bucket(block: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64("g", block), F.lit(buckets)).cast("int")


def _block_runs(table: pa.Table) -> Iterator[tuple[tuple, int, pa.Table]]:
    """((g, block), levels inside it, its rows in order) of each block in a table of nodes."""
    table = table.sort_by([("g", "ascending"), ("pos", "ascending")])
    keys = [(g, pos // BLOCK) for g, pos in zip(table["g"].to_pylist(), table["pos"].to_pylist(), strict=True)]
    start = 0
    for end in range(1, len(keys) + 1):
        if end == len(keys) or keys[end] != keys[start]:
            yield keys[start], min(HEIGHT, table["height"][start].as_py()), table.slice(start, end - start)
            start = end


def _hex(column: pa.ChunkedArray) -> list[str | None]:
    return [None if x is None else x.hex() for x in column.to_pylist()]


class Forest:
    """Trees over (g, pos, height, digest): every group's nodes at each block height, and its root."""

    def __init__(self, leaves: DataFrame):
        self.levels, self.ends = [], []
        nodes = leaves.select("g", "pos", "height", "digest")
        while True:
            self.levels.append(nodes)
            made = durable(self._roots(nodes))
            self.ends.append(made.where("height = 0").select("g", "digest"))
            nodes = made.where("height > 0")
            if nodes.isEmpty():
                break

    @staticmethod
    def _roots(nodes: DataFrame) -> DataFrame:
        """(g, pos, height, digest) of each block's root."""

        def run(table: pa.Table) -> pa.Table:
            out = [(*key, own["height"][0].as_py() - height, bytes.fromhex(block_root(_hex(own["digest"]), height))) for key, height, own in _block_runs(table)]
            return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["g", "pos", "height", "digest"])

        return _dealt(nodes, F.floor(F.col("pos") / BLOCK)).groupBy("bucket").applyInArrow(run, "g string, pos long, height int, digest binary")

    def tops(self) -> DataFrame:
        """g, digest: the root of each group."""
        out = self.ends[0]
        for more in self.ends[1:]:
            out = out.unionByName(more)
        return out

    def above(self, given: DataFrame) -> DataFrame:
        """g, block, path, top: the path above each block of leaves, where `given` has those above each group's root (g, path, top)."""
        out = None
        for k in reversed(range(len(self.levels))):
            own = self.ends[k].join(given, "g").select("g", F.lit(0).cast("long").alias("block"), "path", "top")
            out = own if out is None else durable(self._paths(self.levels[k + 1], out)).unionByName(own)
        return out

    @staticmethod
    def _paths(nodes: DataFrame, above: DataFrame) -> DataFrame:
        """g, block, path, top of each node, from the path above its block; the node's own place is the block below it."""

        def run(own: pa.Table, upper: pa.Table) -> pa.Table:
            known = {(r["g"], r["block"]): r for r in upper.to_pylist()}
            out = []
            for key, height, rows in _block_runs(own):
                top = known[key]
                for pos, path in zip(rows["pos"].to_pylist(), traverse(_hex(rows["digest"]), height), strict=True):
                    out.append((key[0], pos, "/".join(filter(None, [_text(path), top["path"]])), top["top"]))
            columns = zip(*out, strict=True) if out else [[]] * 4
            return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["g", "block", "path", "top"])

        return _with_upper(nodes, above).applyInArrow(run, "g string, block long, path string, top string")


def _dealt(nodes: DataFrame, block: Column) -> DataFrame:
    buckets = _buckets(nodes)
    return nodes.withColumn("bucket", _bucket(block.cast("long"), buckets))


def _buckets(nodes: DataFrame) -> int:
    return max(width(nodes.sparkSession), -(-nodes.count() // TOGETHER))


def _with_upper(nodes: DataFrame, above: DataFrame):
    """Nodes and the paths above their blocks, grouped so that whole blocks meet them."""
    buckets = _buckets(nodes)
    own = nodes.withColumn("bucket", _bucket(F.floor(F.col("pos") / BLOCK).cast("long"), buckets))
    return own.groupBy("bucket").cogroup(above.withColumn("bucket", _bucket(F.col("block"), buckets)).groupBy("bucket"))


def merkle_manifest(
    docs: DataFrame, values: list[str], key: str = "doc_id", group: str = "source", claimed: Column | None = None, with_proof: bool = False
) -> DataFrame:
    """One row per row of `docs`: the key, leaf, subroot, root, proof_sha256, folded_root, verified.

    leaf is the digest of `values`, subroot that of the group's tree, root that of all
    subroots, groups in the order of their UTF-8 bytes, null first. proof_sha256 is the digest
    of the row's siblings from its run up to the root. `claimed` is the leaf digest that a row
    is checked with (default: its own): folded_root is where it leads, verified whether that
    is the root. with_proof adds `proof`, an array with a run a level: the place in it, then the siblings.

    Rows of a group go by key, null first; rows that share a key, also repeated ones, by
    their leaf. A null group is a group of its own, a null or empty value has its own
    encoding. A text of any length is hashed by one native expression and never shuffled.
    One row: its leaf is the root and the proof is empty. No rows: no rows. Other columns of
    `docs` are not read, whatever their names.
    """
    own = leaf(*[docs[v] for v in values])
    g = F.coalesce(F.concat(F.lit("="), docs[group].cast("string")), F.lit(""))
    presented = own if claimed is None else claimed
    hashed = docs.select(docs[key].alias("key"), g.alias("g"), own.alias("leaf"), presented.alias("claimed"))
    slim = durable(
        hashed.select("key", "g", F.unhex("leaf").alias("digest"), F.when(F.col("claimed") != F.col("leaf"), F.unhex("claimed")).alias("claimed"), F.monotonically_increasing_id().alias("row"))
    )
    key_type = slim.schema["key"].dataType.simpleString()
    placed = positions(slim, "g", ["key", "digest", "row"])
    leaves = durable(placed.select("key", "g", F.col("__pos").alias("pos"), _height(F.col("__size")).alias("height"), "digest", "claimed"))
    trees = Forest(leaves)
    subroots = durable(trees.tops())
    roots = positions(subroots.withColumn("__all", F.lit("")), "__all", ["g"])
    named = durable(roots.select(F.lit("").alias("g"), F.col("__pos").alias("pos"), _height(F.col("__size")).alias("height"), "digest", F.col("g").alias("group")))
    crown = Forest(named)
    top = crown.tops().first()
    root = top["digest"].hex() if top else ""
    # Above a block of groups: nothing but the crown's own path; then each group's, in its place.
    upper = crown.above(docs.sparkSession.createDataFrame([("", "", "")], "g string, path string, top string"))
    given = durable(_crown_paths(named, upper))
    return _finished(leaves, trees.above(given), root, key, key_type, with_proof)


def _crown_paths(named: DataFrame, upper: DataFrame) -> DataFrame:
    """g, path, top of each group: the path from its root to the root of all, and its root."""

    def run(own: pa.Table, above: pa.Table) -> pa.Table:
        known = {r["block"]: r["path"] for r in above.to_pylist()}
        out = []
        for (_, block), height, rows in _block_runs(own):
            roots = _hex(rows["digest"])
            for name, node, path in zip(rows["group"].to_pylist(), roots, traverse(roots, height), strict=True):
                out.append((name, "/".join(filter(None, [_text(path), known[block]])), node))
        columns = zip(*out, strict=True) if out else [[]] * 3
        return pa.Table.from_arrays([pa.array(c, pa.string()) for c in columns], names=["g", "path", "top"])

    return _with_upper(named, upper).applyInArrow(run, "g string, path string, top string")


def _finished(leaves: DataFrame, above: DataFrame, root: str, key: str, key_type: str, with_proof: bool) -> DataFrame:
    """The manifest's rows: each block traversed leaf by leaf, with the shared path above it."""
    names = ["leaf", "subroot", "proof_sha256", "folded_root"]

    def run(own: pa.Table, upper: pa.Table) -> pa.Table:
        known = {(r["g"], r["block"]): r for r in upper.to_pylist()}
        out, keys, proofs = {n: [] for n in names}, [], []
        for place, height, rows in _block_runs(own):
            top = known[place]
            shared = _path(top["path"])
            siblings = "".join(d for _, others in shared for d in others)
            digests = _hex(rows["digest"])
            keys.extend(rows["key"].chunks)
            for node, claimed, path in zip(digests, _hex(rows["claimed"]), traverse(digests, height), strict=True):
                out["leaf"].append(node)
                out["subroot"].append(top["top"])
                out["proof_sha256"].append(digest("".join(d for _, others in path for d in others) + siblings))
                out["folded_root"].append(fold(fold(claimed or node, path), shared))
                if with_proof:
                    proofs.append(list(filter(None, "/".join([_text(path), top["path"]]).split("/"))))
        arrays = [pa.chunked_array(keys, own.schema.field("key").type), *[pa.array(out[n], pa.string()) for n in names]]
        arrays += [pa.array(proofs, pa.list_(pa.string()))] if with_proof else []
        return pa.Table.from_arrays(arrays, names=["key", *names, *["proof"] * with_proof])

    made = _with_upper(leaves, above).applyInArrow(run, f"key {key_type}, leaf string, subroot string, proof_sha256 string, folded_root string" + ", proof array<string>" * with_proof)
    return made.select(
        F.col("key").alias(key), "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"), *["proof"] * with_proof
    )
