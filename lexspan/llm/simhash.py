"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. If two fingerprints differ in few bits, they differ in
very few in some segment; so for each fingerprint the small Hamming ball within each
segment is enumerated, and the tables of segment values are asked for each. Matches are
verified over all 64 bits. Only distinct fingerprints take part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import ceil, comb, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import Bloom, without
from .common import block_pairs, durable, join_by_key, width
from .components import connected_components

BITS = 64


def shingles(text: bytes, words: int) -> list[bytes]:
    """The word shingles of a text, A-Z folded, repeats included; fewer words: all as one."""
    split = text.lower().split()  # bytes: ASCII alone changes, and the six white-space characters separate
    if len(split) <= words:
        return [b" ".join(split)] if split else []
    joined = b" ".join(split)
    ends, at = [], -1
    for w in split:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    return [joined[a:b] for a, b in zip(starts, ends[words - 1 :], strict=False)]


#: For each byte a number whose bytes are its bits, so that sums of these count bits.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def majority(hashes: np.ndarray) -> np.ndarray:
    """The bits (uint8 0 or 1) that over half of the 64-bit hashes have."""
    counts = np.zeros(BITS, np.int64)
    for low in range(0, len(hashes), 255):  # a byte counts to 255
        counts += _SPREAD[hashes[low : low + 255, None].view(np.uint8)].sum(0, dtype=np.uint64).view(np.uint8)
    return (counts * 2 > len(hashes)).astype(np.uint8)


def fingerprints(texts: list[bytes], words: int) -> np.ndarray:
    """64-bit fingerprints (uint64): a bit is set if over half the shingles' XXH64 (seed 42) have it."""
    from xxhash import xxh64_intdigest

    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        found = shingles(text, words)
        if found:
            hashes = np.array([xxh64_intdigest(s, 42) for s in found], np.uint64)
            out[i] = np.packbits(majority(hashes), bitorder="little").view(np.uint64)[0]
    return out


def with_fingerprint(docs: DataFrame, words: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (as a signed long) of each row; null, empty and blank texts: 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(fingerprints(texts, words).view(np.int64))], names=["doc_id", "fingerprint"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, fingerprint long")


def segments(count: int, distance: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of the segments for so many fingerprints.

    The radii add up to distance + 1 less the number of segments, so two fingerprints within
    the distance are within the radius in some segment. Of all numbers of segments, that with
    the fewest probes and expected matches is taken; more fingerprints make wider segments.
    """

    def layout(m: int) -> list[tuple[int, int, int]]:
        spare, out, shift = distance + 1 - m, [], 0
        for k in range(m):
            wide = BITS // m + (k < BITS % m)
            out.append((shift, wide, spare // m + (k < spare % m)))
            shift += wide
        return out

    def cost(m: int) -> float:
        return sum(sum(comb(w, r) for r in range(radius + 1)) * (1 + count / 2**w) for _, w, radius in layout(m))

    return layout(min(range(1 if distance == 0 else 2, distance + 2), key=cost))


def balls(width: int, radius: int) -> list[int]:
    """The masks of a Hamming ball, itself first."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _near(distance: int) -> Callable:
    """Rows sorted by bucket: in each, links that connect what is within the distance."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def linked(prints: np.ndarray) -> tuple[list, list]:
        """A spanning forest: each print that is reached is compared with those not yet reached.

        A dense group is reached from its first print at once, so its pairs aren't all formed.
        """
        left, a, b = prints, [], []
        while len(left) > 1:
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                at = queue.pop()
                near = np.bitwise_count(left ^ at) <= distance
                if near.any():
                    found = left[near]
                    a += [at] * len(found)
                    b += found.tolist()
                    queue += found.tolist() if len(found) < len(left) else []
                    left = left[~near]
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups(key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch | None:
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[first, len(key)])
            a, b = [], []
            two = first[size == 2]
            x, y = prints[two], prints[two + 1]
            near = np.bitwise_count(x ^ y) <= distance
            pairs = [(x[near], y[near])]
            for low, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                more = linked(np.unique(prints[low : low + n]))
                a += more[0]
                b += more[1]
            pairs.append((np.array(a, np.uint64), np.array(b, np.uint64)))
            x, y = (np.concatenate(p) for p in zip(*pairs, strict=True))
            keep = x != y
            return pa.record_batch([pa.array(x[keep].view(np.int64)), pa.array(y[keep].view(np.int64))], schema=schema) if keep.any() else None

        keys, prints = [], []
        for batch in batches:
            keys.append(batch.column(0).to_numpy())
            prints.append(batch.column(1).to_numpy().view(np.uint64))
            if keys[-1][-1:] != keys[0][:1] and sum(map(len, keys)) > 50_000:
                key, own = np.concatenate(keys), np.concatenate(prints)
                cut = int(np.flatnonzero(key != key[-1])[-1]) + 1
                if out := groups(key[:cut], own[:cut]):
                    yield out
                keys, prints = [key[cut:]], [own[cut:]]
        if keys and sum(map(len, keys)) and (out := groups(np.concatenate(keys), np.concatenate(prints))):
            yield out

    return run


def fingerprint_links(prints: DataFrame, count: int, distance: int = 4, column: str = "fingerprint") -> DataFrame:
    """a, b: links among distinct fingerprints that connect all within the distance.

    Each fingerprint stands in its own buckets and in those that its Hamming balls reach.
    What a bucket returns are fewer links than it has fingerprints. A bucket holds distinct
    fingerprints of 8 bytes each, about one on average; only those that agree on a whole
    segment but for the radius can crowd it.
    """
    layout = segments(count, distance)
    tagged = []
    for k, (shift, wide, radius) in enumerate(layout):
        value = F.shiftrightunsigned(F.col(column), shift).bitwiseAND(F.lit((1 << wide) - 1))
        masks = F.array(*[F.lit(m).cast("long") for m in balls(wide, radius)])
        reached = F.transform(masks, lambda mask: value.bitwiseXOR(mask).bitwiseOR(F.lit(k << 58)))  # noqa: B023
        tagged.append(reached)
    probes = prints.select(F.explode(F.concat(*tagged)).alias("bucket"), F.col(column).alias("print"))
    n = max(width(prints.sparkSession), 1)
    return (
        probes.repartition(n, "bucket").sortWithinPartitions("bucket")
        .mapInArrow(_near(distance), "a long, b long").distinct()
    )


def near_components(hashed: DataFrame, distance: int = 4) -> DataFrame:
    """Adds component_id to (doc_id, fingerprint): the smallest doc_id reached by links, itself included.

    A component of nothing but null ids has a null id.
    """
    prints = durable(hashed.groupBy("fingerprint").agg(F.min("doc_id").alias("__least"), F.count(F.lit(1)).alias("__rows")))
    roots = connected_components(fingerprint_links(prints, prints.count(), distance), "a", "b")
    rooted = prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "__least", "__rows", F.coalesce("root", "fingerprint").alias("__root")
    )
    least = rooted.groupBy("__root").agg(F.min("__least").alias("component_id"))
    named = durable(rooted.join(least, "__root").select("fingerprint", "component_id", "__rows"))
    return join_by_key(hashed, named, "fingerprint", "__rows", hashed.count()).drop("__rows")


def simhash_groups(docs: DataFrame, words: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 lowercase hex digits), component_id.

    Texts without words have fingerprint zero and are linked like any others. Repeated rows
    are kept. Empty table: no rows. Other columns aren't read.
    """
    hashed = durable(with_fingerprint(docs, words, doc_id, text))
    found = near_components(hashed, distance)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


#: For similarity rather than a given distance: 64-bit words of a fingerprint, least bits of a sampled segment, and
#: the chance that a pair that differs in as many bits as the similarity makes them shares no segment.
WIDE, SAMPLE_BITS, MISS = 4, 18, 0.025
#: Standard deviations by which fingerprints of a candidate pair may be farther apart than the similarity makes them.
DEVIATIONS = 3
#: Bytes of shingle sets, and texts, of a block; two blocks meet in a task.
BLOCK_BYTES, BLOCK = 16_000_000, 4096
_STREAMS = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03], np.uint64)


def wide_fingerprints(texts: list[bytes], words: int) -> np.ndarray:
    """Fingerprints of WIDE words: each word from the different shingles' XXH64, mixed by another multiplier."""
    return set_prints([shingle_set(t, words) for t in texts])


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, so that few shingle sets are held at once."""
    return (batch.slice(low, rows) for batch in batches for low in range(0, batch.num_rows, rows))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The sorted XXH64 (seed 42) of a text's different shingles."""
    from xxhash import xxh64_intdigest

    return np.unique(np.array([xxh64_intdigest(s, 42) for s in shingles(text, words)], np.uint64))


def set_digest(hashes: np.ndarray) -> bytes:
    """16 bytes by which equal shingle sets are known."""
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(hashes.tobytes())


def set_prints(sets: list[np.ndarray]) -> np.ndarray:
    """Wide fingerprints of shingle sets."""
    out = np.zeros((len(sets), WIDE * BITS), np.uint8)
    for i, hashes in enumerate(sets):
        if len(hashes):
            for k in range(WIDE):
                x = hashes * _STREAMS[k]
                x = (x ^ (x >> np.uint64(29))) * _STREAMS[(k + 1) % 4]
                out[i, k * BITS : (k + 1) * BITS] = majority(x ^ (x >> np.uint64(32)))
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


def distance_for(similarity: float) -> int:
    """Bits in which fingerprints of texts of a Jaccard similarity differ, plus DEVIATIONS standard deviations."""
    share = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    bits = WIDE * BITS
    return round(bits * share + DEVIATIONS * np.sqrt(bits * share * (1 - share)))


def expected_distance(similarity: float) -> int:
    """Bits in which fingerprints of texts of a Jaccard similarity differ on average."""
    return round(WIDE * BITS * float(np.arccos(2 * similarity / (1 + similarity)) / np.pi))


def samples_for(count: int, similarity: float) -> tuple[int, int]:
    """(bits of a sample, samples) for so many fingerprints: more of them, wider samples, and more for the same MISS."""
    wide = max(SAMPLE_BITS, (max(count, 1) - 1).bit_length() - 6)
    agree = comb(WIDE * BITS - expected_distance(similarity), wide) / comb(WIDE * BITS, wide)
    return wide, 1 if agree == 1 else ceil(log(MISS) / log1p(-agree))


def _probes(batches: Iterator[pa.RecordBatch], width_: int, count: int) -> Iterator[pa.RecordBatch]:
    rng = np.random.default_rng(3)
    samples = [rng.choice(WIDE * BITS, width_, replace=False) for _ in range(count)]
    weights = np.int64(1) << np.arange(width_, dtype=np.int64)
    for batch in batches:
        for low in range(0, batch.num_rows, 1000):
            part = batch.slice(low, 1000)
            node, prints = part.column(0).to_numpy(), np.stack([part.column(k + 1).to_numpy() for k in range(WIDE)], 1)
            bits = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8), axis=1, bitorder="little")
            buckets = [(bits[:, sample] @ weights) | np.int64(k << 48) for k, sample in enumerate(samples)]
            n = len(buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(buckets)), pa.array(np.tile(node, n)), *[pa.array(np.tile(prints[:, k], n)) for k in range(WIDE)]],
                ["bucket", "node", *[f"f{k}" for k in range(WIDE)]],
            )


def _far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(1, dtype=np.int64)


def _ordered(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The different pairs, the smaller node first."""
    none = np.zeros(0, np.int64)
    x, y = np.concatenate([none, *a]), np.concatenate([none, *b])
    return np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)


def _spanning(key: np.ndarray, node: np.ndarray, prints: np.ndarray, distance: int) -> np.ndarray:
    """Pairs within the distance that connect all such pairs of a bucket: fewer than it has nodes."""
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    hub = np.repeat(first, size)
    near = (_far(prints, prints[hub]) <= distance) & (np.arange(len(key)) != hub)
    a, b = [node[hub[near]]], [node[near]]
    # Where the first node doesn't reach all others, each one reached is compared with those not yet reached.
    beyond = size - 1 - np.add.reduceat(near.astype(np.int64), first) if len(first) else first
    for low, n in zip(first[(beyond > 0) & (size > 2)].tolist(), size[(beyond > 0) & (size > 2)].tolist(), strict=True):
        own = np.arange(low, low + n)
        queue, left = own[near[own]].tolist(), own[1:][~near[own[1:]]]
        while len(left) > 1 or (queue and len(left)):
            if not queue:
                queue, left = [left[0]], left[1:]
            one = queue.pop()
            close = _far(prints[left], prints[one][None]) <= distance
            if close.any():
                found, left = left[close], left[~close]
                a.append(np.full(len(found), node[one]))
                b.append(node[found])
                queue += found.tolist()
    return _ordered(a, b)


def _candidates(distance: int) -> Callable:
    """Rows sorted by bucket: pairs that span its buckets, the smaller node first."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def out(pairs: list[np.ndarray]) -> pa.RecordBatch:
        different = np.unique(np.concatenate(pairs), axis=0)
        return pa.record_batch([pa.array(np.ascontiguousarray(different[:, k])) for k in (0, 1)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        pairs: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            prints = np.stack([batch.column(k + 2).to_numpy() for k in range(WIDE)], 1).view(np.uint64)
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), prints))
            if held[-1][0][-1] != held[0][0][0] and sum(len(h[0]) for h in held) > 100_000:
                key, node, prints = (np.concatenate(h) for h in zip(*held, strict=True))
                cut = int(np.flatnonzero(key != key[-1])[-1]) + 1
                held = [(key[cut:], node[cut:], prints[cut:])]
                pairs.append(_spanning(key[:cut], node[:cut], prints[:cut], distance))
                if sum(map(len, pairs)) > 400_000:
                    yield out(pairs)
                    pairs = []
        if held:
            yield out([*pairs, _spanning(*(np.concatenate(h) for h in zip(*held, strict=True)), distance)])

    return run


def common(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many of the sorted hashes each of the others, none empty, has too."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    return np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum([0, *map(len, others[:-1])]))


def _similar(similarity: float) -> Callable:
    """Rows (a, salt, side, node, set) sorted by the first three, a's own set at side 0: a, node if similar enough."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, None
        for batch in slices(batches):
            a, b = [], []
            for key, side, node, packed in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), strict=True):
                hashes = np.frombuffer(packed.as_buffer(), np.uint64)
                if side == 0:
                    hub, own = key, hashes.copy()
                    continue
                if hub != key:
                    raise RuntimeError("a candidate pair without its first set")
                both = int(common(own, [hashes])[0]) if len(own) and len(hashes) else 0
                if both / max(1, len(own) + len(hashes) - both) >= similarity:
                    a.append(key)
                    b.append(node)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    return run


def settle(root: np.ndarray, prints: np.ndarray, sets: list[np.ndarray], side: np.ndarray, distance: int, similarity: float, at_once: int = 32) -> list[tuple[int, int]]:
    """Places of similar pairs, of one side and the other or both of side 0, that connect whatever such pairs of different roots connect.

    The closest fingerprints are compared first, and nothing that is connected by then.
    """
    label, size, links = np.unique(root, return_inverse=True)[1], np.array([len(x) for x in sets]), []
    for x in np.flatnonzero((side != 2) & (size > 0)).tolist():
        others = np.flatnonzero(side == 2) if side[x] == 1 else np.flatnonzero(side[x + 1 :] == 0) + x + 1
        alike = np.minimum(size[others], size[x]) >= similarity * np.maximum(size[others], size[x])
        others = others[alike & (label[others] != label[x])]
        far = _far(prints[others], prints[x][None])
        others = others[far <= distance][np.argsort(far[far <= distance], kind="stable")]
        while len(others):
            part, others = others[:at_once], others[at_once:]
            both = common(sets[x], [sets[y] for y in part])
            for y in part[both >= similarity * (size[x] + size[part] - both)].tolist():
                if label[y] != label[x]:
                    links.append((x, y))
                    label[label == label[y]] = label[x]
            others = others[label[others] != label[x]]
    return links


def _settled(distance: int, similarity: float) -> Callable:
    """Rows (task, side, root, node, fingerprint, set) sorted by task: links a, b of each task. One task's rows are held at a time."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(rows: list[tuple]) -> pa.RecordBatch:
        side, root, node, prints, sets = zip(*rows, strict=True)
        pairs = settle(np.array(root), np.array(prints, np.int64).view(np.uint64).reshape(-1, WIDE), list(sets), np.array(side), distance, similarity)
        ends = [[min(node[x], node[y]) for x, y in pairs], [max(node[x], node[y]) for x, y in pairs]]
        return pa.record_batch([pa.array(e, pa.int64()) for e in ends], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows = None, []
        for batch in slices(batches):
            own = [c.to_pylist() for c in batch.columns[: 4 + WIDE]]
            for key, one_side, root, node, *prints, packed in zip(*own, batch.column(4 + WIDE), strict=True):
                if key != task and rows:
                    yield links(rows)
                    rows = []
                task = key
                rows.append((one_side, root, node, prints, np.frombuffer(packed.as_buffer(), np.uint64).copy()))
        if rows:
            yield links(rows)

    return run


def shingle_sets(slim: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node, set of (node, __row, digest): read again from the rows of `slim`, of which few others shuffle."""
    met = Bloom(nodes, "__row").mark(slim, "row").where("__suspect").select("row", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t or b"", words) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            # Another text under the same key has another digest.
            same = [k for k, d in enumerate(batch.column(1).to_pylist()) if set_digest(sets[k]) == d]
            yield pa.record_batch([batch.column(0).take(pa.array(same, pa.int64())), pa.array([sets[k].tobytes() for k in same], pa.binary())], names=["node", "set"])

    rows = met.join(nodes, met["row"] == nodes["__row"]).select("node", "digest", "text")
    return rows.mapInArrow(run, "node long, set binary").dropDuplicates(["node"])


def similar_pairs(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs a, b of nodes whose shingle sets have at least the Jaccard similarity.

    A node's set goes to at most as many places as there are shuffle partitions, and its
    pairs are dealt out among these; a task holds one set and a batch of others at a time.
    """
    n = width(pairs.sparkSession)
    salted = pairs.withColumns({"salt": F.pmod(F.xxhash64("b"), F.lit(n)), "place": F.pmod(F.xxhash64("a"), F.lit(n))})
    hubs = salted.select("a", "salt").distinct().join(sets, F.col("a") == F.col("node")).select("a", "salt", F.lit(0).alias("side"), "node", "set")
    placed = salted.select("b", "place").distinct().join(sets, F.col("b") == F.col("node")).select("b", "place", "set")
    leaves = salted.join(placed, ["b", "place"]).select("a", "salt", F.lit(1).alias("side"), F.col("b").alias("node"), "set")
    return hubs.unionByName(leaves).repartition(n, "a", "salt").sortWithinPartitions("a", "salt", "side").mapInArrow(_similar(similarity), "a long, b long")


def near_links(prints: DataFrame, slim: DataFrame, words: int, similarity: float) -> DataFrame:
    """a, b: links that connect the nodes that candidate pairs of at least the similarity connect.

    Only pairs whose exact similarity was checked are links. Each node is first checked
    against its smallest candidate. Where a pair that spans a bucket isn't connected by
    these, its similarity or that of others across it is in doubt: there all texts that such
    pairs lead to meet in blocks, whose pairs are compared where they are and never listed.
    """
    parts = [f"f{k}" for k in range(WIDE)]
    fields = ", ".join(f"{p} long" for p in parts)
    n = width(slim.sparkSession)
    wide, samples = samples_for(prints.count(), similarity)
    distance = distance_for(similarity)
    probes = prints.select("node", *parts).mapInArrow(lambda b: _probes(b, wide, samples), f"bucket long, node long, {fields}")
    spanning = probes.repartition(n, "bucket").sortWithinPartitions("bucket", "node").mapInArrow(_candidates(distance), "a long, b long")
    pairs = durable(spanning.distinct())
    if pairs.isEmpty():
        return pairs
    wanted = durable(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
    rows = prints.select("node", F.col("__least.row").alias("__row"), "digest").join(wanted, "node")
    sets = durable(shingle_sets(slim, durable(rows), words))
    links = durable(similar_pairs(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), sets, similarity))
    known = wanted.join(connected_components(links, "a", "b"), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    known = durable(known)
    left, right = known.select(F.col("node").alias("a"), F.col("root").alias("__a")), known.select(F.col("node").alias("b"), F.col("root").alias("__b"))
    doubt = durable(pairs.join(left, "a").join(right, "b").where("__a <> __b").select("__a", "__b").distinct())
    if doubt.isEmpty():
        return links
    crowds = connected_components(doubt, "__a", "__b").select(F.col("node").alias("root"), F.col("root").alias("crowd"))
    sized = known.join(crowds, "root").join(sets.select("node", F.octet_length("set").alias("bytes")), "node")
    sized = durable(sized)
    blocks = durable(sized.groupBy("crowd").agg(F.count(F.lit(1)).alias("size"), F.sum("bytes").alias("bytes")).select(
        "crowd", "size", F.ceil(F.greatest(F.col("size") / BLOCK, F.col("bytes") / BLOCK_BYTES, F.lit(1.0))).cast("int").alias("blocks")
    ))
    met = join_by_key(sized.drop("bytes"), blocks, "crowd", "size", sized.count())
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = met.withColumn("mine", mine).select("node", "root", "crowd", F.explode(block_pairs(F.col("mine"), F.col("blocks"))).alias("t"))
    tasks = dealt.select(F.xxhash64("crowd", "t.i", "t.j").alias("task"), "t.side", "root", "node")
    tasks = tasks.join(prints.select("node", *parts), "node").join(sets, "node").select("task", "side", "root", "node", *parts, "set")
    more = tasks.repartition(n, "task").sortWithinPartitions("task").mapInArrow(_settled(distance, similarity), "a long, b long")
    return links.unionByName(durable(more))


def near_dedup(docs: DataFrame, words: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, of which one of each group of near-duplicates stays.

    Texts are near-duplicates if the sets of their shingles of `words` words have a Jaccard
    similarity of at least `similarity`. Groups are what such links connect; the smallest
    doc_id stays. Candidates are pairs that share a bucket and whose fingerprints of 256
    bits differ in at most as many bits as the similarity makes them, plus DEVIATIONS
    standard deviations; the similarity of each is then checked on the sets themselves.
    Buckets are samples of a fingerprint's bits, as many of them, whatever the table's size,
    as leave a chance of MISS that two texts whose fingerprints differ as the threshold
    makes them share none; it falls fast above the threshold. A row is known by its id and
    the hash of its text, so rows that share an id are told apart; of rows equal in both one
    stays, and a null id is larger than all others. Texts without words are one group.
    Empty table: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t or b"", words) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            prints = set_prints(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([set_digest(x) for x in sets], pa.binary()), *[pa.array(np.ascontiguousarray(prints[:, k])) for k in range(WIDE)]],
                ["doc_id", "row", "digest", *parts],
            )

    parts = [f"f{k}" for k in range(WIDE)]
    fields = ", ".join(f"{p} long" for p in parts)
    own, content = docs[doc_id].cast("long"), docs[text].cast("string")
    row = F.xxhash64(own, content)
    slim = docs.select(own.alias("doc_id"), row.alias("row"), content.alias("text"))
    hashed = durable(slim.mapInArrow(run, f"doc_id long, row long, digest binary, {fields}"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    prints = durable(
        hashed.groupBy("digest").agg(F.min(order).alias("__least"), *[F.min(p).alias(p) for p in parts]).withColumn("node", F.monotonically_increasing_id())
    )
    roots = connected_components(near_links(prints, slim, words, similarity), "a", "b")
    rooted = prints.join(roots, "node", "left").withColumn("__root", F.coalesce("root", "node"))
    stays = rooted.groupBy("__root").agg(F.min("__least").alias("__stays"))
    named = rooted.join(stays, "__root").select("digest", "__stays")
    goes = hashed.join(named, "digest").where(order != F.col("__stays")).select(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).distinct()
    once = hashed.groupBy("doc_id", "row").count().where("count > 1").select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"))
    return without(docs, own, row, goes, once)
