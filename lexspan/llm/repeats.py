"""Finds every window of L consecutive units that also starts in a document with a smaller id.

Units are bytes or words. Windows can't all be shuffled, so each is found by an anchor: of
the k-grams in a window, the one with the smallest hash (the last of equals). The anchor
depends on the window's content alone, and consecutive windows mostly share it, so a
document becomes runs of windows, one for each anchor, at about 2/(L-k+2) runs a unit.

1. Documents are dealt into batches by id. Each batch sends its anchors' hashes, by bucket;
   the reply says of each whether it is repeated at all, and whether it is hot.
2. Runs with a repeated anchor are sent as pieces, the text that their windows span, equal
   ones of a batch once. Runs of a hot anchor are sent window by window, dealt by the
   window's own hash, so that no key gathers more than one row from each batch.
3. Where the pieces of an anchor meet, a matcher (a suffix sort or a suffix automaton)
   finds equal windows, comparing contents, and replies which windows are found earlier.
4. Each batch marks what those windows cover.

The batches' exchange serves steps 1, 2 and 4. Hashes only choose what to compare.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import width

#: Text bytes a batch should hold, and occurrences from which an anchor is hot.
BATCH, HOT = 4_000_000, 4096
#: Windows whose anchors are sought at once, and pieces that are matched at once.
SLICE, PART = 1 << 16, 4000
LARGEST = np.iinfo(np.int64).max

_BASE, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOW, _HIGH = np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000)
_BYTES = np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = int(_BASE)) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of an odd base modulo 2**64, and of its inverse."""
    if base not in _powers or len(_powers[base][0]) < n:
        n = max(n, SLICE + 256)
        _powers[base] = tuple(np.cumprod(np.r_[np.uint64(1), np.full(n, b, np.uint64)]) for b in (base, pow(base, -1, 2**64)))
    return _powers[base]


def prefix_hashes(symbols: np.ndarray, base: int = int(_BASE)) -> np.ndarray:
    """H with hash(i, j) = (H[j] - H[i]) * inverse**i, for random 64-bit symbols."""
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * powers(len(symbols), base)[0][: len(symbols)], out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX1
    x = (x ^ (x >> np.uint64(29))) * _MIX2
    return x ^ (x >> np.uint64(32))


def gather(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of a buffer, one behind the other, and their bounds."""
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    return buffer[np.repeat(starts - bounds[:-1], lengths) + np.arange(bounds[-1])], bounds


class Bytes:
    """A batch as UTF-8 bytes."""

    def __init__(self, texts: list[bytes]):
        self.buffer = np.frombuffer(b"".join(texts), np.uint8)
        self.bounds = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
        self.count = len(self.buffer)

    def symbols(self, low: int, high: int) -> np.ndarray:
        return _BYTES[self.buffer[low:high]]

    def stretch(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte starts and lengths of units first..last, the last left out."""
        return first, last - first

    def kept(self, low: int, high: int, removed: np.ndarray) -> bytes:
        return self.buffer[low:high][~removed[low:high]].tobytes()


class Words:
    """A batch as words, which one space separates in the buffer."""

    def __init__(self, texts: list[bytes]):
        split = [t.split() for t in texts]  # bytes split at the six ASCII white-space characters only
        self.bounds = np.r_[0, np.cumsum([len(s) for s in split])].astype(np.int64)
        self.words = [w for s in split for w in s]
        self.buffer = np.frombuffer(b" ".join(self.words), np.uint8)
        self.count = len(self.words)
        lengths = np.fromiter(map(len, self.words), np.int64, self.count)
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        self.ends = self.starts + lengths
        hashes = prefix_hashes(_BYTES[self.buffer])
        self.hashes = mixed((hashes[self.ends] - hashes[self.starts]) * powers(len(self.buffer) + 1)[1][self.starts] + lengths.astype(np.uint64)) if self.count else np.zeros(0, np.uint64)

    def symbols(self, low: int, high: int) -> np.ndarray:
        return self.hashes[low:high]

    def stretch(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.starts[first], self.ends[last - 1] - self.starts[first]

    def kept(self, low: int, high: int, removed: np.ndarray) -> bytes:
        return b" ".join([w for w, r in zip(self.words[low:high], removed[low:high].tolist(), strict=True) if not r])


def runs(units, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: anchor hash, first window, windows, hash of the run's content."""
    wide = length - gram + 1
    parts = []
    windows = units.count - length + 1
    power, inverse = powers(SLICE + 2 * length)
    ends = units.bounds[1:]
    for low in range(0, max(windows, 0), SLICE):
        n = min(SLICE, windows - low)
        symbols = units.symbols(low, low + n + length - 1)
        prefix = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * power[: len(symbols)], out=prefix[1:])
        grams = mixed((prefix[gram:] - prefix[:-gram]) * inverse[: len(symbols) - gram + 1])
        least = (grams & _HIGH) | (_LOW - np.arange(len(grams), dtype=np.uint64))
        have = 1
        while 2 * have <= wide:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < wide:
            least = np.minimum(least[: have - wide], least[wide - have :])
        anchor = (_LOW - (least & _LOW)).astype(np.int64)
        # Windows that would run over the end of their document.
        over = np.zeros(n + 1, np.int32)
        near = ends[np.searchsorted(ends, low, "right") : np.searchsorted(ends, low + n + length, "left") + 1]
        np.add.at(over, np.clip(np.maximum(near - length + 1, np.r_[low, near[:-1]] if len(near) else near) - low, 0, n), 1)
        np.add.at(over, np.clip(near - low, 0, n), -1)
        inside = np.cumsum(over[:n]) == 0
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])])
        count = np.diff(np.r_[first, n])
        first, count = first[inside[first]], count[inside[first]]
        content = mixed((prefix[first + count + length - 1] - prefix[first]) * inverse[first] + count.astype(np.uint64))
        # Least hashes are small numbers: mixed once more, they fill the buckets evenly.
        parts.append((mixed(grams[anchor[first]] + _BASE), first + low, count, content))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def window_hashes(units, length: int, first: np.ndarray) -> np.ndarray:
    """Hash of each window's content."""
    out = np.empty(len(first), np.uint64)
    power, inverse = powers(SLICE + 2 * length)
    for low in range(0, units.count, SLICE):
        own = np.flatnonzero((first >= low) & (first < low + SLICE))
        if len(own):
            prefix = np.zeros(min(SLICE + length, units.count - low) + 1, np.uint64)
            symbols = units.symbols(low, low + len(prefix) - 1)
            np.cumsum(symbols * power[: len(symbols)], out=prefix[1:])
            at = first[own] - low
            out[own] = mixed((prefix[at + length] - prefix[at]) * inverse[at] + np.uint64(1))
    return out


def bucket_ranges(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets (leading bits) that sorted keys lie in, and where the keys of each begin and end."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    low = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return bucket[low], low, np.r_[low[1:], len(keys)] if len(keys) else low


def short_keys(keys: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits behind the bucket's. A bucket has few enough keys that hardly any collide, and those that do cost a comparison."""
    return (keys << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)


class Batch:
    """A batch's documents and runs; after `reply`, its pieces, numbered alike whenever they are made."""

    def __init__(self, kind, table: pa.Table, length: int, gram: int):
        self.length = length
        # In an order of their own, as a shuffle may deliver them in any: runs are cut and numbered by it.
        rows = [(x, y or b"") for x, y in zip(table["doc_id"].to_pylist(), table["text"].cast(pa.binary()).to_pylist(), strict=True)]
        # A null id counts as larger than any other, and as equal to other nulls.
        rows.sort(key=lambda r: (LARGEST if r[0] is None else r[0], r[1]))
        self.docs = [r[0] for r in rows]
        self.ids = np.array([LARGEST if i is None else i for i in self.docs], np.int64)
        self.units = kind([r[1] for r in rows])
        self.anchor, self.first, self.count, self.content = runs(self.units, length, gram)
        self.keys, self.key_of, self.times = np.unique(self.anchor, return_inverse=True, return_counts=True)

    def reply(self, replies: pa.Table, bits: int) -> None:
        buckets, lows, highs = bucket_ranges(self.keys, bits)
        repeated, hot = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        for bucket, a, b in zip(*(replies[c].to_pylist() for c in ("bucket", "a", "b")), strict=True):
            if bucket >= 0:
                at = np.searchsorted(buckets, bucket)
                low, high = lows[at], highs[at]
                repeated[low:high] = np.unpackbits(np.frombuffer(a, np.uint8), count=high - low)
                hot[low:high] = np.unpackbits(np.frombuffer(b, np.uint8), count=high - low)
        key, first, count, content = self.anchor, self.first, self.count, self.content
        plain, split = np.flatnonzero((repeated & ~hot)[self.key_of]), np.flatnonzero(hot[self.key_of])
        single = np.repeat(first[split] - np.r_[0, np.cumsum(count[split])[:-1]], count[split]) + np.arange(count[split].sum())
        hashes = window_hashes(self.units, self.length, single)
        key, first, count, content = (
            np.concatenate(x) for x in ((key[plain], hashes), (first[plain], single), (count[plain], np.ones(len(single), np.int64)), (content[plain], hashes))
        )
        order = np.lexsort((first, content, key))
        self.key, self.first, self.count, content = key[order], first[order], count[order], content[order]
        n = len(order)
        new = np.ones(n, bool)
        new[1:] = (self.key[1:] != self.key[:-1]) | (content[1:] != content[:-1]) | (self.count[1:] != self.count[:-1])
        # Equal hashes must mean equal contents: each run is compared with the one before it.
        same = np.flatnonzero(~new)
        here, width = self.units.stretch(self.first[same], self.first[same] + self.count[same] + self.length - 1)
        there, width2 = self.units.stretch(self.first[same - 1], self.first[same - 1] + self.count[same - 1] + self.length - 1)
        differ = width != width2
        for low in range(0, len(same), 100_000):
            part = slice(low, low + 100_000)
            w = np.minimum(width[part], width2[part])
            x, bounds = gather(self.units.buffer, here[part], w)
            y, _ = gather(self.units.buffer, there[part], w)
            differ[part] |= np.add.reduceat(x != y, bounds[:-1]) > 0
        new[same[differ]] = True
        self.heads = np.flatnonzero(new)
        self.piece_of = np.cumsum(new) - 1
        self.run_ids = self.ids[np.searchsorted(self.units.bounds, self.first, "right") - 1]
        self.least = np.minimum.reduceat(self.run_ids, self.heads) if n else np.zeros(0, np.int64)


def _send_keys(kind, length: int, gram: int, bits: int):
    schema = pa.schema([("batch", pa.int32()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        batch = Batch(kind, table, length, gram)
        buckets, lows, highs = bucket_ranges(batch.keys, bits)
        short = short_keys(batch.keys, bits)
        times = np.minimum(batch.times, 65535).astype(np.uint16)
        return pa.table({
            "batch": pa.array([key[0].as_py()] * len(buckets), pa.int32()), "bucket": pa.array(buckets, pa.int32()),
            "a": pa.array([short[low:high].tobytes() for low, high in zip(lows, highs, strict=True)], pa.binary()),
            # The low bytes and then the high ones, which are nearly all zero.
            "b": pa.array([times[low:high].view(np.uint8).reshape(-1, 2).T.tobytes() for low, high in zip(lows, highs, strict=True)], pa.binary()),
        }, schema)

    return run


def _reply_keys(key: tuple, table: pa.Table) -> pa.Table:
    keys = table["a"].to_pylist()
    times = [np.frombuffer(t, np.uint8).reshape(2, -1).T.astype(np.int64) @ (1, 256) for t in table["b"].to_pylist()]
    _, which = np.unique(np.frombuffer(b"".join(keys), np.uint32), return_inverse=True)
    total = np.bincount(which, np.concatenate([np.zeros(0), *times]))[which]
    edges = np.r_[0, np.cumsum([len(t) for t in times])]
    pack = lambda x: [np.packbits(x[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.table({"batch": table["batch"], "bucket": table["bucket"], "a": pa.array(pack(total >= 2), pa.binary()), "b": pa.array(pack(total >= HOT), pa.binary())})


def _send_pieces(kind, length: int, gram: int, bits: int):
    """A row for each bucket: its pieces' keys, least ids, windows and contents, compressed."""
    from zstandard import ZstdCompressor

    schema = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("first", pa.int32()), ("n", pa.int32()), ("data", pa.binary())])

    def run(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        batch = Batch(kind, docs, length, gram)
        batch.reply(replies, bits)
        keys, first, count = batch.key[batch.heads], batch.first[batch.heads], batch.count[batch.heads]
        starts, widths = batch.units.stretch(first, first + count + length - 1)
        buckets, lows, highs = bucket_ranges(keys, bits)
        short, press, data = short_keys(keys, bits), ZstdCompressor(level=3), []
        for x, y in zip(lows, highs, strict=True):
            contents, _ = gather(batch.units.buffer, starts[x:y], widths[x:y])
            parts = (short[x:y], batch.least[x:y], widths[x:y].astype(np.int32), count[x:y].astype(np.uint8), contents)
            # Numbers byte by byte, so that alike bytes stand together.
            data.append(press.compress(b"".join(p.view(np.uint8).reshape(len(p), -1).T.tobytes() for p in parts)))
        return pa.table({
            "bucket": pa.array(buckets, pa.int32()), "batch": pa.array([key[0].as_py()] * len(buckets), pa.int32()),
            "first": pa.array(lows, pa.int32()), "n": pa.array(highs - lows, pa.int32()), "data": pa.array(data, pa.binary()),
        }, schema)

    return run


def _match(matcher: Callable, length: int):
    """matcher(key, content buffer, bounds, windows, least, length): for each piece, the bits of the windows that an earlier document has."""
    from zstandard import ZstdDecompressor

    schema = pa.schema([("batch", pa.int32()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])

    def numbers(data: bytes, at: int, n: int, kind) -> tuple[np.ndarray, int]:
        size = np.dtype(kind).itemsize
        return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel(), at + n * size

    def run(_: tuple, table: pa.Table) -> pa.Table:
        press, columns, contents = ZstdDecompressor(), [], []
        for n, packed in zip(table["n"].to_pylist(), table["data"].to_pylist(), strict=True):
            data, own, at = press.decompress(packed), [], 0
            for kind in (np.uint32, np.int64, np.int32, np.uint8):
                values, at = numbers(data, at, n, kind)
                own.append(values)
            columns.append(own)
            contents.append(data[at:])
        key, least, widths, windows = (np.concatenate(c) for c in zip(*columns, strict=True))
        starts, buffer = np.r_[0, np.cumsum(widths, dtype=np.int64)[:-1]], np.frombuffer(b"".join(contents), np.uint8)
        masks = np.zeros(len(key), np.uint32)
        # In parts that fit a processor's cache, each with all pieces of its keys.
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        low = 0
        while low < len(order):
            high = int(np.searchsorted(ranked, ranked[min(low + PART, len(order)) - 1], "right"))
            own = order[low:high]
            content, bounds = gather(buffer, starts[own], widths[own].astype(np.int64))
            masks[own] = matcher(ranked[low:high].astype(np.int64), content, bounds, windows[own].astype(np.int64), least[own], length)
            low = high
        out, at = [], 0
        for batch, first, n in zip(*(table[c].to_pylist() for c in ("batch", "first", "n")), strict=True):
            found = np.flatnonzero(masks[at : at + n])
            if len(found):
                out.append((batch, -1, (first + found).astype(np.int32).tobytes(), masks[at + found].tobytes()))
            at += n
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    return run


def _finish(kind, length: int, gram: int, bits: int, with_content: bool):
    def run(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        batch = Batch(kind, docs, length, gram)
        batch.reply(replies, bits)
        masks = np.zeros(len(batch.heads), np.uint32)
        for bucket, a, b in zip(*(replies[c].to_pylist() for c in ("bucket", "a", "b")), strict=True):
            if bucket < 0:
                masks[np.frombuffer(a, np.int32)] = np.frombuffer(b, np.uint32)
        later = batch.run_ids > batch.least[batch.piece_of] if len(batch.first) else np.zeros(0, bool)
        bitmask = np.where(later, np.uint32(0xFFFFFFFF), masks[batch.piece_of] if len(batch.first) else np.zeros(0, np.uint32))
        cover = np.zeros(batch.units.count + 1, np.int32)
        for j in range(int(batch.count.max()) if len(batch.count) else 0):
            at = batch.first[(batch.count > j) & ((bitmask >> np.uint32(j)) & np.uint32(1) > 0)] + j
            cover[at] += 1
            cover[at + length] -= 1
        removed = np.cumsum(cover[:-1]) > 0
        bounds = batch.units.bounds
        out: dict[str, list] = {c: [] for c in ("doc_id", "n_units", "n_removed", "n_spans", "kept_sha256", "spans", "kept")}
        for doc, low, high in zip(batch.docs, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = np.diff(np.r_[0, removed[low:high].astype(np.int8), 0])
            starts, ends = np.flatnonzero(own == 1), np.flatnonzero(own == -1)
            kept = batch.units.kept(low, high, removed)
            for c, v in zip(out, (doc, high - low, int((ends - starts).sum()), len(starts), hashlib.sha256(kept).hexdigest(), np.stack([starts, ends], 1).tolist(), kept), strict=True):
                out[c].append(v if with_content or c not in ("spans", "kept") else None)
        return pa.table(out, pa.schema([("doc_id", pa.int64()), ("n_units", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())]))

    return run


RESULT = "doc_id long, n_units long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>, kept binary"


def remove_repeats(docs: DataFrame, kind, length: int, gram: int, matcher: Callable, doc_id: str, text: str, with_content: bool, batch_bytes: int = BATCH) -> DataFrame:
    """One row per row of `docs`, as RESULT says; spans and kept only if `with_content`."""
    if not 1 <= gram <= length or length - gram + 1 > 32:
        raise ValueError("an anchor must leave 1 to 32 windows")
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    total = slim.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    batches = max(1, -(-total // batch_bytes))
    bits = max(batches - 1, width(docs.sparkSession) - 1).bit_length()
    # By id and text, so that rows of one id, null ids too, are spread; ids are compared wherever they lie.
    dealt = slim.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int")).select("batch", "doc_id", "text")
    blobs = "batch int, bucket int, a binary, b binary"
    own = dealt.groupBy("batch")
    keys = own.applyInArrow(_send_keys(kind, length, gram, bits), blobs)
    replies = keys.groupBy("bucket").applyInArrow(_reply_keys, blobs)
    pieces = own.cogroup(replies.groupBy("batch")).applyInArrow(_send_pieces(kind, length, gram, bits), "bucket int, batch int, first int, n int, data binary")
    masks = pieces.repartition(width(docs.sparkSession), "bucket").groupBy("bucket").applyInArrow(_match(matcher, length), blobs)
    return own.cogroup(replies.unionByName(masks).groupBy("batch")).applyInArrow(_finish(kind, length, gram, bits, with_content), RESULT)
