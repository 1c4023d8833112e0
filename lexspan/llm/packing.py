"""Bounded-space online packing of documents into sequences of a fixed number of tokens.

Each partition keeps a fixed number of open windows. A document's full windows are cut off
first; its rest goes whole into the open window that it fits best. When none fits and all
windows are open, the fullest is emitted, filled from the piece if it would otherwise carry
more than a little padding. Windows still open at a partition's end are merged: their pieces
are packed again, whole, for groups of partitions. Memory is bounded by the open windows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable

WINDOW, OPEN, PAD, END = 2048, 64, 16, 1
#: Partitions whose leftovers one merging task packs, and characters of a text that are tokenized at once.
MERGED, STRETCH = 64, 200_000

#: Where a text can be cut: before a single space between two other characters.
_CUT = re.compile(r"(?<=\S)(?= \S)")
# How byte-level pre-tokenizers cut a text into pieces.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: itself if it is one, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def _ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary as byte strings and ids, if the file is a plain byte-level model with ids in the order of its merges.

    Then merging by id, as `tiktoken` does, is merging by the file's rules.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    cut, model, letters = file.get("pre_tokenizer") or {}, file["model"], _byte_letters()
    plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True) and not file.get("normalizer")
    if not plain or model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if len(vocab) != 256 + len(merges) or any(vocab.get("".join(m)) != 256 + k for k, m in enumerate(merges)):
        return None
    return {bytes(letters[c] for c in token): i for token, i in vocab.items()}


class Encoder:
    """Token ids of a text as unsigned 32-bit numbers (little-endian, as all machines here), by a `tokenizers` file.

    `tiktoken` runs a plain byte-level file, about three times as fast and without a cache;
    `tokenizers` runs any other, and stretches that can't be cut. A long text is tokenized in stretches that end before a
    single space between two other characters, which no piece ever spans. Special tokens'
    strings are ordinary text.
    """

    def __init__(self, path: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        ranks = _ranks(path)
        self.fast = Encoding("file", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary if ranks else None

    def _ids(self, text: str) -> list[int]:
        # `tiktoken` fails on a run of a million spaces, which is never cut.
        return self.fast(text) if self.fast and len(text) <= 4 * STRETCH else self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, text: str) -> bytes:
        if len(text) <= STRETCH:
            return array("I", self._ids(text)).tobytes()
        out, low = [], 0
        while low < len(text):
            cut = _CUT.search(text, low + STRETCH)
            high = cut.start() if cut else len(text)
            out.append(array("I", self._ids(text[low:high])).tobytes())
            low = high
        return b"".join(out)

    def batch(self, texts: list[str]) -> list[bytes]:
        return [self.encode(text) for text in texts]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Windows:
    """Open windows, placed best-fit. `add` gives the windows that it closed."""

    def __init__(self, size: int = WINDOW, most: int = OPEN, pad: int | None = PAD):
        """pad None: pieces are never cut, and windows open without limit if `most` is None."""
        self.size, self.most, self.pad = size, most, pad
        self.free: list[tuple[int, int]] = []
        self.held: dict[int, list] = {}
        self.made = 0

    def add(self, piece, length: int, cut: Callable | None = None) -> Iterator[list]:
        """Places a piece; `cut(piece, n)` splits it after n tokens."""
        while True:
            at = bisect_left(self.free, (length, -1))
            if at < len(self.free):
                free, w = self.free.pop(at)
                self.held[w].append(piece)
                if free == length:
                    yield self.held.pop(w)
                else:
                    insort(self.free, (free - length, w))
                return
            if self.most is None or len(self.free) < self.most:
                self.made += 1
                self.held[self.made] = [piece]
                if length == self.size:
                    yield self.held.pop(self.made)
                else:
                    insort(self.free, (self.size - length, self.made))
                return
            free, w = self.free.pop(0)
            full = self.held.pop(w)
            if self.pad is not None and free > self.pad:
                head, piece = cut(piece, free)
                length -= free
                full.append(head)
            yield full

    def rest(self) -> list[list]:
        """The windows that are still open, fullest first."""
        left, self.free = [self.held[w] for _, w in self.free], []
        self.held = {}
        return left


FIELDS = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("part", pa.int32()),
])
SPARK_FIELDS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part int"


def _rows(windows: Iterable[tuple[int, list]], part: int) -> Iterator[pa.RecordBatch]:
    """Arrow rows of (sequence_id, pieces); part -1 marks windows that are done."""
    columns: list[list] = [[] for _ in FIELDS]
    for sequence, pieces in windows:
        offset = 0
        for doc, start, length, crc, total in pieces:
            for column, value in zip(columns, (doc, start, length, crc, total, sequence, offset, part), strict=True):
                column.append(value)
            offset += length
        if len(columns[0]) >= 20_000:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, FIELDS, strict=True)], schema=FIELDS)
            columns = [[] for _ in FIELDS]
    if columns[0]:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, FIELDS, strict=True)], schema=FIELDS)


def _packer(path: str, size: int, most: int, pad: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, open_windows = encoder(path), Windows(size, most, pad)
        part = TaskContext.get().partitionId()
        tail = end.to_bytes(4, "little")
        made = 0

        def split(piece, n):
            doc, start, ids, total = piece
            return (doc, start, ids[: 4 * n], total), (doc, start + n, ids[4 * n :], total)

        def finished(pieces):
            return [(doc, start, len(ids) // 4, zlib.crc32(ids), total) for doc, start, ids, total in pieces]

        def closed():
            nonlocal made
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = tokens.encode(text.as_py() or "") + tail
                    total = len(ids) // 4
                    whole = total // size
                    for k in range(whole):
                        made += 1
                        yield (part << 32) | made, finished([(doc, k * size, ids[4 * k * size : 4 * (k + 1) * size], total)])
                    if total > whole * size:
                        for pieces in open_windows.add((doc, whole * size, ids[4 * whole * size :], total), total - whole * size, split):
                            made += 1
                            yield (part << 32) | made, finished(pieces)

        yield from _rows(closed(), -1)
        yield from _rows(((k, finished(pieces)) for k, pieces in enumerate(open_windows.rest())), part)

    return run


def _merger(size: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        order = sorted(zip(*(table[f.name].to_pylist() for f in FIELDS), strict=True), key=lambda r: (-r[2], r[7], r[5], r[6]))
        windows, group = Windows(size, None, None), key[0].as_py()
        done = []
        for row in order:
            done += windows.add(row[:5], row[2])
        done += windows.rest()
        return pa.Table.from_batches(_rows((((1 << 62) | (group << 32) | k, pieces) for k, pieces in enumerate(done)), -1), FIELDS)

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = WINDOW, open_windows: int = OPEN, pad: int = PAD, end: int = END,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its tokens (null text: none) and then `end`; each lies in one piece.
    Sequences hold at most `size` tokens. A null doc_id stays null; repeated rows are packed
    each; a very long text becomes whole windows and a rest; empty table: no rows. Other
    columns aren't read. `tokenizer` is the path of a `tokenizers` file on every machine.
    """
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = durable(slim.mapInArrow(_packer(tokenizer, size, open_windows, pad, end), SPARK_FIELDS))
    left = rows.where("part >= 0").withColumn("__group", F.expr(f"cast(part div {MERGED} AS int)"))
    merged = left.groupBy("__group").applyInArrow(_merger(size), SPARK_FIELDS)
    return rows.where("part < 0").unionByName(merged).drop("part")


def sequences(docs: DataFrame, pieces: DataFrame, tokenizer: str, end: int = END, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """sequence_id, ids array<int>: the packed token ids themselves.

    A piece takes its ids from a document with its doc_id, as many tokens and the same
    checksum of its ids, so documents that share an id are told apart.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tokens = encoder(tokenizer)
        for batch in batches:
            for at, (text, start, length, crc, total) in enumerate(zip(*(batch[c].to_pylist() for c in ("text", "start", "length", "ids_crc32", "doc_tokens")), strict=True)):
                ids = np.frombuffer(tokens.encode(text or "") + end.to_bytes(4, "little"), "<i4")
                own = ids[start : start + length]
                if len(ids) == total and zlib.crc32(own.tobytes()) == crc:
                    yield pa.RecordBatch.from_arrays(
                        [batch["sequence_id"].slice(at, 1), batch["offset"].slice(at, 1), pa.array([own], pa.list_(pa.int32()))],
                        ["sequence_id", "offset", "ids"],
                    )

    own = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text"))
    joined = pieces.join(own, pieces["doc_id"].eqNullSafe(own["__id"])).select("sequence_id", "offset", "start", "length", "ids_crc32", "doc_tokens", "text")
    parts = joined.mapInArrow(cut, "sequence_id long, offset long, ids array<int>")
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_set(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
