"""Removal of repeated byte strings by a hash-compared suffix sort.

Suffixes are grouped by their first sixteen bytes, and each group is sorted by a bottom-up
mergesort. Two suffixes are compared by their prefix polynomial hashes: a binary search over hash equality finds how far they agree, so a comparison takes
a logarithmic number of steps, and the next byte decides. Neighbours in the sorted order
that agree over the whole length are then compared byte by byte; if hashes collided, the
sort is done again with another base. All comparisons of a pass run as array operations.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from . import repeats

LENGTH, GRAM = 50, 26
#: Leading bytes by which suffixes are grouped before they are sorted.
LEADING = 16


class Suffixes:
    """Stretches of a buffer that can be compared by hashes."""

    def __init__(self, buffer: np.ndarray, base: int):
        self.buffer = np.r_[buffer, np.zeros(LEADING, np.uint8)]
        rng = np.random.default_rng(base % 2**32)
        self.prefix = repeats.prefix_hashes(rng.integers(0, 2**64, 256, dtype=np.uint64)[buffer], base)
        self.inverse = repeats.powers(len(buffer) + 1, base)[1]

    def hash(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.prefix[start + size] - self.prefix[start]) * self.inverse[start]

    def agree(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many leading bytes agree, at most `most`."""
        out = most.copy()
        open_ = np.flatnonzero(self.hash(x, most) != self.hash(y, most))
        x, y, low, high = x[open_], y[open_], np.zeros(len(open_), np.int64), most[open_]
        for _ in range(int(most.max(initial=1)).bit_length()):
            middle = (low + high) // 2
            same = self.hash(x, middle) == self.hash(y, middle)
            low, high = np.where(same, np.maximum(middle, low), low), np.where(same, high, middle)
        out[open_] = low
        return out

    def less(self, x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether stretch (x, nx) sorts before (y, ny), and whether they are equal."""
        most = np.minimum(nx, ny)
        n = self.agree(x, y, most)
        ended = n == most
        return np.where(ended, nx < ny, self.buffer[x + n] < self.buffer[y + n]), ended & (nx == ny)

    def sort(self, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the stretches inside each group; groups are contiguous and stay in place."""
        if not len(start):
            return np.zeros(0, np.int64)
        at = np.arange(LEADING)
        leading = np.where(at < size[:, None], self.buffer[start[:, None] + at], 0).astype(np.uint8).view(">u8").astype(np.uint64)
        first = np.lexsort((leading[:, 1], leading[:, 0], group))
        kind = np.c_[group[first].astype(np.uint64), leading[first]]
        return first[self._merge(start[first], size[first], np.cumsum(np.r_[False, (kind[1:] != kind[:-1]).any(1)]))]

    def _merge(self, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The mergesort of each group."""
        n = len(start)
        order = np.arange(n)
        begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.r_[begins, n])
        begin, total = np.repeat(begins, sizes), np.repeat(sizes, sizes)
        place = np.arange(n) - begin
        width, widest = 1, int(sizes.max())
        while width < widest:
            active = np.flatnonzero(total > width)
            b, t, p = begin[active], total[active], place[active]
            run = p // width
            left = run % 2 == 0
            low0 = np.where(left, (run + 1) * width, (run - 1) * width)
            low, high = np.minimum(low0, t), np.minimum(low0 + width, t)
            first = low.copy()
            own = order[active]
            # Rank in the sibling run: of equals, those of the left run come first.
            going = np.flatnonzero(low < high)
            while len(going):
                middle = (low[going] + high[going]) // 2
                other = order[b[going] + middle]
                mine = own[going]
                before, equal = self.less(start[other], size[other], start[mine], size[mine])
                after = before | (equal & ~left[going])
                low[going] = np.where(after, middle + 1, low[going])
                high[going] = np.where(after, high[going], middle)
                going = going[low[going] < high[going]]
            pair = (run // 2) * 2 * width
            order[b + pair + (p - run * width) + (low - first)] = own
            width *= 2
        return order

    def equal_to_previous(self, order: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray | None:
        """Which of a sorted order equal the one before them, in its group; None if hashes collided."""
        s, z, g = start[order], size[order], group[order]
        same = np.zeros(len(order), bool)
        at = np.flatnonzero((g[1:] == g[:-1]) & (z[1:] == z[:-1])) + 1
        at = at[self.hash(s[at], z[at]) == self.hash(s[at - 1], z[at])]
        same[at] = True
        for low in range(0, len(at), 100_000):
            part = at[low : low + 100_000]
            x, _ = repeats.gather(self.buffer, s[part], z[part])
            y, _ = repeats.gather(self.buffer, s[part - 1], z[part])
            if not np.array_equal(x, y):
                return None
        return same


def match(key: np.ndarray, buffer: np.ndarray, bounds: np.ndarray, windows: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """For each piece, the bits of its windows that a piece with a smaller least id has too."""
    base = int(repeats._BASE)
    while (found := _match(key, buffer, bounds, windows, least, length, base)) is None:
        base = (base * 6364136223846793005 + 1442695040888963407) % 2**64 | 1
    return found


def _match(key, buffer, bounds, windows, least, length, base) -> np.ndarray | None:
    suffixes = Suffixes(buffer, base)
    # Pieces first: a suffix array of whole pieces under each anchor; equal ones become one.
    by_key = np.argsort(key, kind="stable")
    start, size, group = bounds[:-1][by_key], np.diff(bounds)[by_key], key[by_key]
    order = suffixes.sort(start, size, group)
    same = suffixes.equal_to_previous(order, start, size, group)
    if same is None:
        return None
    order = by_key[order]
    piece_class = np.empty(len(key), np.int64)
    piece_class[order] = np.cumsum(~same) - 1
    heads = order[~same]
    if not len(heads):
        return np.zeros(0, np.int64)
    class_least = np.minimum.reduceat(least[order], np.flatnonzero(~same))
    # Where pieces of an anchor differ, the suffixes at each of their windows.
    head_key = key[heads]
    new = np.r_[True, head_key[1:] != head_key[:-1]]
    kinds = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1]
    earliest = np.repeat(class_least[:, None], int(windows.max(initial=1)), axis=1)
    mixed = np.flatnonzero(kinds > 1)
    if len(mixed):
        count = windows[heads[mixed]]
        owner = np.repeat(mixed, count)
        offset = np.arange(len(owner)) - np.repeat(np.r_[0, np.cumsum(count)[:-1]], count)
        start = bounds[:-1][heads[owner]] + offset
        group = head_key[owner]
        order = suffixes.sort(start, np.full(len(start), length), group)
        same = suffixes.equal_to_previous(order, start, np.full(len(start), length), group)
        if same is None:
            return None
        least_of = np.minimum.reduceat(class_least[owner[order]], np.flatnonzero(~same))
        earliest[owner[order], offset[order]] = least_of[np.cumsum(~same) - 1]
    masks = np.zeros(len(key), np.int64)
    for j in range(earliest.shape[1]):
        masks |= ((earliest[piece_class, j] < least) & (windows > j)).astype(np.int64) << j
    return masks


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text", with_content: bool = False) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept.

    A byte is removed if a string of `length` bytes that covers it also starts in a document
    with a smaller doc_id; strings are judged on the input, overlaps count, and none crosses
    documents. Null text counts as empty, and texts shorter than `length` lose nothing. Rows
    that share a doc_id don't remove from each other; a null doc_id counts as larger than
    any other. spans (start, end in bytes) and kept (the remaining bytes) are null unless
    `with_content`. Empty table: no rows. Other columns aren't read.
    """
    return repeats.remove_repeats(docs, repeats.Bytes, length, gram, match, doc_id, text, with_content).withColumnRenamed("n_units", "n_bytes")
