"""Removal of repeated word sequences by suffix automata of reference shards.

Earlier documents are the reference. Their texts grow with the corpus, so no automaton of
them all is broadcast: the reference is dealt into shards of bounded size by the anchors of
`repeats`, each shard's automaton is built where it is used, and the documents' pieces are
streamed through it for their matching statistics, the longest match that ends at each
word. A window is repeated where that reaches the length and the automaton's state was
first made by an earlier document.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from . import repeats

LENGTH, GRAM = 13, 6


class SuffixAutomaton:
    """Of several sequences, added in order. first[s]: tag of the sequence that made state s's strings first."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.size, self.first = [-1], [0], [None]

    def add(self, sequence: list, tag) -> None:
        nxt, link, size, first = self.next, self.link, self.size, self.first
        last = 0
        for c in sequence:
            q = nxt[last].get(c)
            if q is not None:  # the extended string is known already
                if size[q] == size[last] + 1:
                    last = q
                    continue
                last = self._clone(last, q, c)
                continue
            cur = len(nxt)
            nxt.append({})
            size.append(size[last] + 1)
            first.append(tag)
            link.append(0)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                link[cur] = q if size[q] == size[p] + 1 else self._clone(p, q, c)
            last = cur

    def _clone(self, p: int, q: int, c) -> int:
        nxt, link, size = self.next, self.link, self.size
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        size.append(size[p] + 1)
        self.first.append(self.first[q])
        link.append(link[q])
        link[q] = clone
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def matches(self, sequence: list, length: int):
        """For each position at which a match of `length` ends: (position, first tag of that string)."""
        nxt, link, size = self.next, self.link, self.size
        state = have = 0
        for at, c in enumerate(sequence):
            while state and c not in nxt[state]:
                state = link[state]
                have = size[state]
            if c in nxt[state]:
                state = nxt[state][c]
                have += 1
            # Of the longer matches only the last `length` symbols matter.
            while size[link[state]] >= length if state else False:
                state = link[state]
                have = size[state]
            if have >= length:
                yield at, self.first[state]


def match(key: np.ndarray, buffer: np.ndarray, bounds: np.ndarray, windows: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """For each piece, the bits of its windows that a piece with a smaller least id has too."""
    data = buffer.tobytes()
    edges = bounds.tolist()
    pieces = [data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    keys, ids = key.tolist(), least.tolist()
    # Copies of a piece are one reference, with the smallest id.
    earliest: dict[tuple, int] = {}
    for pair, doc in zip(zip(keys, pieces, strict=True), ids, strict=True):
        if doc < earliest.get(pair, doc + 1):
            earliest[pair] = doc
    # Documents are added in order of their ids, so that a state's first tag is the smallest.
    split = {pair: pair[1].split(b" ") for pair in earliest}
    shard = SuffixAutomaton()
    for pair in sorted(earliest, key=earliest.__getitem__):
        shard.add(split[pair], earliest[pair])
    found = {pair: list(shard.matches(words, length)) for pair, words in split.items()}
    masks = np.zeros(len(keys), np.int64)
    for i, (pair, doc) in enumerate(zip(zip(keys, pieces, strict=True), ids, strict=True)):
        masks[i] = sum(1 << (at - length + 1) for at, first in found[pair] if first < doc)
    return masks


def substring_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text", with_content: bool = False) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, n_spans, kept_sha256, spans, kept.

    A word is removed if a window of `length` words of its document that covers it also
    starts in a document with a smaller doc_id; windows are judged on the input. kept joins
    the remaining words by one space; spans (first, end in words) are the maximal removed
    runs; both are null unless `with_content`. Null text has no words, and texts of fewer
    words than `length` lose nothing. Rows that share a doc_id don't remove from each other;
    a null doc_id counts as larger than any other. Empty table: no rows. Other columns
    aren't read.
    """
    return repeats.remove_repeats(docs, repeats.Words, length, gram, match, doc_id, text, with_content).withColumnRenamed("n_units", "n_words")
