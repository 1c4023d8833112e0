"""Quality rules whose cutoffs come with a bound on how many good documents they reject.

Each rule compares a statistic of a text with a cutoff. One part of the labelled documents
(the fit part) puts all (rule, cutoff) pairs in one order: those that reject bad documents at
the least cost in good ones come first. A verdict is a number of steps along this path. The
other part (the holdout) decides how far each stratum may go: with k of its n good holdout
documents rejected by then, a step holds if P(Bin(n, risk) <= k) is at most the stratum's
share of the error, which says that the exact (Clopper-Pearson) upper bound of the
rejected share isn't above the risk. As k only grows along the path, the last step
that holds is that of a fixed-sequence test, which needs no correction for the number of steps;
the error is divided among the strata (Bonferroni). So with probability 1 - error, no
stratum loses more than the risk of its good documents.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import durable, unused

#: Words of a window that may repeat; bytes of a text handled at once; cutoffs of a rule.
WINDOW, SLICE, CUTOFFS = 8, 1 << 20, 24
#: Share of a stratum's good documents that may be rejected, and the chance that a bound of any stratum fails.
RISK, ERROR = 0.02, 0.05
#: A cutoff is of use if it rejects bad documents so many times as often as good ones; one of FOLDS labelled documents is in the fit part.
LIFT, FOLDS = 3.0, 3
#: Strata whose steps are broadcast at most; more are joined by a shuffle.
MOST_STRATA = 10_000

#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

_KIND = np.zeros(256, np.uint8)  # 1: white space, 2: a byte that continues a character, 3: a symbol
_KIND[[0x20, *range(0x09, 0x0E)]] = 1
_KIND[0x80:0xC0] = 2
_KIND[list(SYMBOLS)] = 3
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _slices(data: bytes) -> Iterator[bytes]:
    """The text in slices of about SLICE bytes that don't cut a word."""
    low = 0
    while low < len(data):
        cut = _SPACE.search(data, low + SLICE)
        high = cut.end() if cut else len(data)
        yield data[low:high] if low or high < len(data) else data
        low = high


def repeat_words(ids: np.ndarray) -> int:
    """Words covered by windows of WINDOW words that stand in the text twice or more, by numbers that tell words apart.

    Pairs are numbered by sorting; windows whose pairs all repeat are compared as two
    fours, numbered again. No hashes, so nothing to verify; memory is a few numbers a word.
    """
    n = len(ids)
    if n <= WINDOW:
        return 0
    kinds = np.int64(ids.max()) + 1
    _, pair, count = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True, return_counts=True)
    often = count[pair] > 1
    at = np.flatnonzero(often[: n - 7] & often[2 : n - 5] & often[4 : n - 3] & often[6 : n - 1])
    if not len(at):
        return 0
    pairs = np.int64(len(count))
    _, four = np.unique(np.r_[pair[at] * pairs + pair[at + 2], pair[at + 4] * pairs + pair[at + 6]], return_inverse=True)
    fours = np.int64(four.max()) + 1
    _, own, count = np.unique(four[: len(at)] * fours + four[len(at) :], return_inverse=True, return_counts=True)
    starts = at[count[own] > 1]
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def counts_of(data: bytes) -> tuple[int, ...]:
    """COUNTS of one text in UTF-8."""
    numbers: dict[bytes, int] = {}
    ids, kinds = [], np.zeros(4, np.int64)
    for part in _slices(data):
        kinds += np.bincount(_KIND[np.frombuffer(part, np.uint8)], minlength=4)
        words = part.split()  # bytes split at exactly the six white-space characters
        ids.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
    own = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    del numbers, ids
    lines, seen = 0, set()
    for line in io.BytesIO(data):
        if line.strip():
            lines += 1
            seen.add(line.removesuffix(b"\n"))
    return len(own), int(kinds[0] + kinds[3]), int(kinds[3]), lines - len(seen), repeat_words(own), lines


def with_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (default: all) and COUNTS as longs; columns of those names are replaced."""
    columns = [c for c in (docs.columns if keep is None else keep) if c.lower() not in COUNTS]
    sent = docs.select(*[docs[c] for c in columns], docs[text].cast("string").alias(unused("__text", columns)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(columns)).cast(pa.binary())
            made = np.array([counts_of(t.as_py() or b"") for t in texts], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(made[:, k]) for k in range(len(COUNTS))]], names=[*batch.schema.names[:-1], *COUNTS])

    return sent.mapInArrow(run, T.StructType([*sent.schema.fields[:-1], *[T.StructField(c, T.LongType()) for c in COUNTS]]))


def base_failed() -> Column:
    """The rule that needs no labels: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """Each rule's statistic; the higher, the worse. Null (no words) fails no rule."""
    rate = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    length = rate("word_chars", "n_words")
    return {
        "symbols": rate("n_symbols", "n_words"), "long_words": length, "short_words": -length, "few_words": -F.col("n_words").cast("double"),
        "dup_lines": rate("n_dup_lines", "n_lines"), "repeat_words": rate("n_repeat_words", "n_words"),
    }


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k) for k below n * p: terms from the largest down, until they no longer count."""
    if k < 0:
        return 0.0
    term = exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log1p(-p))
    total = 0.0
    for j in range(k, -1, -1):
        total += term
        if term < total * 1e-18:
            break
        term *= j * (1 - p) / ((n - j + 1) * p)
    return total


def most_rejected(n: int, risk: float, error: float) -> int:
    """The most of n good documents that may be rejected for the exact upper bound at this error to be at most the risk; -1: not even none."""
    low, high = -1, int(n * risk)  # at the mean the tail is about a half
    while low < high:
        k = (low + high + 1) // 2
        low, high = (k, high) if binomial_cdf(k, n, risk) <= error else (low, k - 1)
    return low


@dataclass(frozen=True)
class Rules:
    """The path of (rule, cutoff), and how many steps of it hold in which stratum."""

    path: list[tuple[str, float]]
    steps: DataFrame  # stratum, __n, __steps

    def step(self) -> Column:
        """The first step that rejects a row with COUNTS; null: none."""
        ladders = []
        for rule, value in statistics().items():
            ladder = F.lit(None).cast("int")
            for k, (name, cutoff) in reversed(list(enumerate(self.path))):
                if name == rule:
                    ladder = F.when(value >= F.lit(cutoff), F.lit(k)).otherwise(ladder)
            ladders.append(ladder)
        return F.least(*ladders)


def _stratum(docs: DataFrame, by: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), docs[by].cast("string")), F.lit(""))


def _labelled(counted: DataFrame, labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """One row per labelled id that passes the base rule: __stratum, COUNTS, good, fits."""
    one = counted.where(F.col(doc_id).isNotNull() & ~base_failed()).groupBy(F.col(doc_id).alias("__id")).agg(F.min(F.struct("__stratum", *COUNTS)).alias("r"))
    known = labels.where(labels[doc_id].isNotNull()).groupBy(labels[doc_id].alias("__id")).agg(F.min(labels[label]).alias("low"), F.max(labels[label]).alias("good"))
    both = one.join(known.where("low = good AND good IN (0, 1)"), "__id")
    fits = F.pmod(F.xxhash64(F.col("__id").cast("string"), F.lit("quality")), F.lit(FOLDS)) == 0
    return both.select("r.*", (F.col("good") == 1).alias("good"), fits.alias("fits"))


def _path(fit: DataFrame) -> list[tuple[str, float]]:
    """All useful (rule, cutoff), those first that cost the fewest good documents for the bad ones they add.

    Cutoffs are quantiles of the bad documents, so that each adds about as many of them.
    What reaches the driver are a few hundred counts.
    """
    values = statistics()
    shares = [k / CUTOFFS for k in range(CUTOFFS)]
    found = fit.where(~F.col("good")).agg(*[F.percentile_approx(v, shares, 10_000).alias(r) for r, v in values.items()]).first()
    cutoffs = {r: sorted(set(found[r] or []), reverse=True) for r in values}
    level = lambda r: F.size(F.filter(F.array(*[F.lit(c) for c in cutoffs[r]]), lambda c: c > values[r]))  # noqa: E731  how many cutoffs spare the row
    kept = [r for r in values if cutoffs[r]]
    if not kept:
        return []
    exploded = fit.select("good", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.when(values[r].isNotNull(), level(r)).otherwise(len(cutoffs[r])).alias("level")) for r in kept])).alias("x"))
    tally = {(r["rule"], r["level"], r["good"]): r["count"] for r in exploded.groupBy("x.rule", "x.level", "good").count().collect()}
    all_ = {g: max(1, sum(n for (r, _, own), n in tally.items() if r == kept[0] and own == g)) for g in (True, False)}
    priced = []
    for order, rule in enumerate(kept):
        price = 0.0
        for k, cutoff in enumerate(cutoffs[rule]):
            good, bad = ((tally.get((rule, k, g), 0) + 0.5) / all_[g] for g in (True, False))
            price = max(price, good / bad)  # a rule's cutoffs keep their order
            if price * LIFT <= 1:
                priced.append((price, order, k, rule, cutoff))
    return [(rule, cutoff) for *_, rule, cutoff in sorted(priced)]


def fit_rules(counted: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", risk: float = RISK, error: float = ERROR) -> Rules:
    """Rules from documents with COUNTS and __stratum, and labels (1: good, 0: bad).

    An id counts once however often its row or its label is repeated; ids with
    contradicting labels, null ids and labels count not at all, nor do documents that fail
    the base rule. All labelled documents count; the holdout is summed by Spark to a row a
    stratum and step. Strata with too few good holdout documents to bound anything
    (fewer than log(error / strata) / log(1 - risk)) have no step, so that nothing is rejected there.
    """
    labelled = durable(_labelled(counted, labels, doc_id, label))
    path = _path(labelled.where("fits"))
    rules = Rules(path, counted.sparkSession.createDataFrame([], "__stratum string, __n long, __steps int"))
    if not path:
        return rules
    good = labelled.where("good AND NOT fits").groupBy("__stratum", F.coalesce(rules.step(), F.lit(len(path))).alias("step")).count()
    tallies = durable(good)
    strata = tallies.select("__stratum").distinct().count()

    def run(table: pa.Table) -> pa.Table:
        rejected = np.zeros(len(path) + 1, np.int64)
        rejected[table["step"].to_numpy()] = table["count"].to_numpy()
        n = int(rejected.sum())
        most = most_rejected(n, risk, error / strata)
        steps = int((np.cumsum(rejected[:-1]) <= most).sum())
        return pa.table({"__stratum": table["__stratum"].slice(0, 1), "__n": pa.array([n]), "__steps": pa.array([steps], pa.int32())})

    steps = tallies.groupBy("__stratum").applyInArrow(run, "__stratum string, __n long, __steps int").where("__steps > 0")
    return Rules(path, durable(steps))


def apply_rules(counted: DataFrame, rules: Rules) -> DataFrame:
    """Adds base_failed, kept and rule (the first that rejects the row, null if none does) to documents with COUNTS and __stratum."""
    steps = rules.steps.select("__stratum", "__steps")
    if steps.count() <= MOST_STRATA:
        steps = F.broadcast(steps)
    step = rules.step() if rules.path else F.lit(None).cast("int")
    failed = step < F.coalesce(F.col("__steps"), F.lit(0))
    names = F.array(*[F.lit(name) for name, _ in rules.path]) if rules.path else F.array().cast("array<string>")
    judged = counted.join(steps, "__stratum", "left").withColumn("__failed", F.coalesce(failed, F.lit(False)))
    return judged.withColumns({
        "base_failed": base_failed(), "kept": ~base_failed() & ~F.col("__failed"), "rule": F.when(F.col("__failed"), F.get(names, step)),
    }).drop("__stratum", "__steps", "__failed")


def quality_rules(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", by: str = "lang", label: str = "quality", risk: float = RISK, error: float = ERROR
) -> DataFrame:
    """One row per row of `docs`: doc_id, COUNTS, base_failed, kept, rule.

    Words are runs of anything but the six ASCII white-space characters, lines are parted by
    line feeds, and only those with a word count. A null or empty text has no words and
    fails the base rule. Strata are the values of `by`, null one of its own. Of the good
    documents of a stratum that pass the base rule, at most `risk` are rejected, for all strata
    at once but for a chance of `error`, if labels are a fair sample. No labels: only
    the base rule rejects. Repeated rows are each judged. A text of any length is read whole, in
    slices, at about 60 bytes a word beside the text. Other columns aren't read.
    """
    counted = durable(with_counts(docs.select(docs[doc_id].alias("doc_id"), _stratum(docs, by).alias("__stratum"), docs[text].alias("text")), "text", ["doc_id", "__stratum"]))
    known = labels.select(labels[doc_id].alias("doc_id"), labels[label].alias("good"))
    return apply_rules(counted, fit_rules(counted, known, "doc_id", "good", risk, error))
