"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed against
each greedily: every phrase is the longest match from where the last one ended, found by
walking the automaton forward. The language that needs the fewest phrases, each at the cost
of a pointer into its reference, wins. Texts are parsed whole, in stretches of 256 letters
that advance together as arrays; no phrase crosses from one to the next.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import first_rows, stretch, unused
from .substring_dedup import SuffixAutomaton

#: Characters of the reference of one language, and of all; the bound of the training sample.
REFERENCE, REFERENCES = 40_000, 400_000
#: Characters that one training text gives, symbols with a column in the tables, letters of a stretch.
A_TEXT, SYMBOLS, STRETCH = 1_000, 56, 256
#: Texts parsed at once, in characters.
AT_ONCE = 1_500_000


def has_letter(text: str) -> bool:
    """Whether a character is a letter (category L), as \\p{L} says."""
    return any(unicodedata.category(c)[0] == "L" for c in text)


def references(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, list[str]]:
    """Texts of each language, at most REFERENCE characters a language and REFERENCES in all.

    The rows are those with the smallest hashes of their id: a sampling rate by language is
    set from its row count, and at most twice the rows wanted are taken of a language, however many
    share an id, so what reaches the driver doesn't grow with the table. Of a text longer than A_TEXT
    characters a stretch of as many is taken, from a hashed place anywhere in it.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text")
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    each = min(REFERENCE, REFERENCES // max(1, len(counts)))
    wanted = 4 * each // A_TEXT + 20
    rate = F.create_map(*[x for lang_, n in counts.items() for x in (F.lit(lang_), F.lit(int(min(1.0, wanted / n) * 2**31)))]) if counts else None
    out: dict[str, list[str]] = {}
    if rate is None:
        return out
    sampled = rows.withColumn("order", F.pmod(F.xxhash64("id", F.lit("language")), F.lit(2**31))).where(F.col("order") < rate[F.col("lang")])
    cut = sampled.select("lang", "order", stretch(F.col("text"), A_TEXT, F.col("id")).alias("text"))
    taken = first_rows(cut, "lang", ["order", "text"], 2 * wanted).collect()
    for r in sorted(taken, key=lambda r: (r["lang"], r["order"], r["text"])):
        own = out.setdefault(r["lang"], [])
        if sum(map(len, own)) + len(r["text"]) <= each or not own:
            own.append(r["text"][:each])
    return out


class Parser:
    """Automata of all languages over a common set of symbols, every character of the references.

    Transitions by the commonest SYMBOLS - 2 of them are dense tables; those by all others
    are found by bisection in a sorted list of (state, symbol).
    """

    def __init__(self, texts: dict[str, list[str]]):
        self.langs = sorted(texts)
        known = Counter(c for own in texts.values() for t in own for c in t.lower())
        self.code = np.zeros(0x110000, np.int32)  # 0: a character that is in no reference
        for k, (c, _) in enumerate(sorted(known.items(), key=lambda x: (-x[1], x[0]))):
            self.code[ord(c)] = k + 1 if k < SYMBOLS - 2 else k + 2  # SYMBOLS - 1 fills stretches up
        self.symbols = SYMBOLS + max(0, len(known) - (SYMBOLS - 2))
        self.tables, self.rare, self.cost = [], [], []
        for lang in self.langs:
            automaton = SuffixAutomaton()
            for t in texts[lang]:
                automaton.add(self.codes(t).tolist(), None)
            table = np.zeros((len(automaton.next), SYMBOLS), np.int32)
            rare = []
            for state, moves in enumerate(automaton.next):
                for c, to in moves.items():
                    if c < SYMBOLS:
                        table[state, c] = to
                    else:
                        rare.append((state * self.symbols + c, to))
            table[:, 0] = 0
            self.tables.append(table.ravel())
            self.rare.append(np.array(sorted(rare) + [(2**62, 0)], np.int64).T.copy())  # the last one ends the search
            self.cost.append(np.log2(2 + sum(map(len, texts[lang]))))

    def codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        return self.code[points]

    def _rare_moves(self, k: int, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Where language k goes from the states by symbols that have no column; 0: nowhere."""
        keys, to = self.rare[k]
        wanted = state.astype(np.int64) * self.symbols + c
        at = np.searchsorted(keys, wanted)
        return np.where(keys[at] == wanted, to[at], 0).astype(np.int32)

    def bits(self, texts: list[str]) -> np.ndarray:
        """Bits a character that each language needs for each text, texts not empty."""
        codes = [self.codes(t) for t in texts]
        lengths = np.array([len(c) for c in codes], np.int64)
        pieces = -(-lengths // STRETCH)
        flat = np.full(int(pieces.sum()) * STRETCH, SYMBOLS - 1, np.int32)
        starts = np.r_[0, np.cumsum(pieces)[:-1]] * STRETCH
        for start, c in zip(starts.tolist(), codes, strict=True):
            flat[start : start + len(c)] = c
        columns = np.ascontiguousarray(flat.reshape(-1, STRETCH).T)
        real = columns != SYMBOLS - 1
        rare = [(at, c[at]) for c in columns for at in [np.flatnonzero(c >= SYMBOLS)]]
        columns[columns >= SYMBOLS] = 0
        out = np.empty((len(texts), len(self.langs)))
        for k, table in enumerate(self.tables):
            state, phrases = np.zeros(columns.shape[1], np.int32), np.zeros(columns.shape[1], np.int64)
            root = table[:SYMBOLS]
            open_ = np.zeros(columns.shape[1], bool)
            for c, is_text, (at, own) in zip(columns, real, rare, strict=True):
                to, fresh = table[state * SYMBOLS + c], root[c]
                if len(at):
                    to[at], fresh[at] = self._rare_moves(k, state[at], own), self._rare_moves(k, np.zeros(len(at), np.int32), own)
                failed = (to == 0) & is_text
                # What was open ends here; a character unknown to the reference is a phrase of its own.
                phrases += (failed & (state != 0)).astype(np.int64) + (failed & (fresh == 0))
                state = np.where(to == 0, fresh, to)
                open_ = np.where(is_text, state != 0, open_)
            totals = np.add.reduceat(phrases + open_, starts // STRETCH)
            out[:, k] = totals * self.cost[k] / lengths
        return out


_parsers: dict[int, Parser] = {}


def identify(docs: DataFrame, texts: dict[str, list[str]], text: str = "text", lang_pred: str = "lang_pred", score: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (default: all), lang_pred and score, for every row.

    Columns that have the names of the new ones are replaced.

    lang_pred is a language of `texts`; `und` with score 0 if the text is null or has no
    letter, or if `texts` is empty. score, 0 to 1, is the winner's share when each language
    counts 2 to the minus four times its bits a character. Of ties the first in code point
    order wins. The references travel with the task: at most REFERENCES characters.
    """
    columns = [c for c in (docs.columns if keep is None else keep) if c not in (lang_pred, score)]
    kept = docs.select(*[docs[c] for c in columns], docs[text].cast("string").alias(unused("__text", columns)))
    mark = hash(tuple((k, tuple(v)) for k, v in sorted(texts.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if mark not in _parsers:
            _parsers.clear()
            _parsers[mark] = Parser(texts)
        parser = _parsers[mark]

        def judged(own: list) -> list[tuple[str, float]]:
            out = [("und", 0.0)] * len(own)
            real = [i for i, t in enumerate(own) if t and parser.langs and has_letter(t)]
            if real:
                bits = parser.bits([own[i] for i in real])
                best = bits.argmin(1)
                share = 1 / np.exp2(-4 * (bits - bits.min(1, keepdims=True))).sum(1)
                for i, b, s in zip(real, best.tolist(), share.tolist(), strict=True):
                    out[i] = (parser.langs[b], s)
            return out

        for batch in batches:
            own, results, at = batch.column(batch.num_columns - 1).to_pylist(), [], 0
            while at < len(own):
                end, size = at, 0
                while end < len(own) and (end == at or size + len(own[end] or "") <= AT_ONCE):
                    size += len(own[end] or "")
                    end += 1
                results += judged(own[at:end])
                at = end
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([r[0] for r in results], pa.string()), pa.array([r[1] for r in results], pa.float64())],
                [*batch.schema.names[:-1], lang_pred, score],
            )

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    return kept.mapInArrow(run, StructType([*kept.schema.fields[:-1], StructField(lang_pred, StringType()), StructField(score, DoubleType())]))


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds; a null id is in the fold of the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def with_letters(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose language can be told: those whose text has a letter."""
    return docs.where(F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
