"""Toxicity by a linear-chain conditional random field over tokens.

Labels mark documents, so tokens are labelled first: a token of a toxic training document is
toxic if its word or its beginning is far commoner in toxic documents than in clean ones.
The field, with two tags, is trained on those; its features are the word, its beginnings and
its ending, hashed. Forward-backward marginals tag every token of a text, and a logistic
model of their sum and maximum, fitted on the documents' labels, gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import first_rows, stretch, unused
from .repeats import powers

#: Bound of the training sample: documents of each label, characters taken of each, and stretches that these are in a longer one.
EACH_LABEL, A_TEXT, PARTS = 1500, 12_000, 12
#: Beginnings (bytes) that are features, hashed weights, and tokens of a stretch.
BEGINNINGS, TABLE, STRETCH = (3, 4, 5, 6), 1 << 18, 128
#: From which log-odds, and how many standard deviations over an even spread, a feature marks tokens.
ODDS, DEVIATIONS = 2.5, 5.0
AT_ONCE = 1_000_000

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SYMBOL = np.random.default_rng(8).integers(0, 2**64, 256, dtype=np.uint64)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features (tokens x kinds, hashed), the text of each token, its byte offset there and its length."""
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = _WORD_BYTE[joined].astype(np.int8)
    edges = np.diff(np.r_[np.int8(0), inside])
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    bounds = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
    owner = np.searchsorted(bounds, starts, "right") - 1
    power, inverse = powers(len(joined) + 1)
    prefix = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_SYMBOL[_FOLD[joined]] * power[: len(joined)], out=prefix[1:])

    def hashed(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
        x = (prefix[b] - prefix[a]) * inverse[a] + np.uint64(kind)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(46)).astype(np.int32)

    kinds = [hashed(starts, ends, 1)]
    kinds += [hashed(starts, np.minimum(starts + n, ends), 1 + n) for n in BEGINNINGS]
    kinds.append(hashed(np.maximum(ends - 3, starts), ends, 20))
    return np.stack(kinds, 1), owner, starts - bounds[owner], ends - starts


def _stretches(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each token in a matrix of stretches; none holds tokens of two texts."""
    n = len(owner)
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if n else np.zeros(0, np.int64)
    at = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
    column = at % STRETCH
    return np.cumsum(column == 0) - 1, column


def marginals(emission: np.ndarray, owner: np.ndarray, move: np.ndarray, want_pairs: bool = False):
    """Probability of tag 1 of each token by forward-backward; the log-odds form needs one number a token.

    move: 2 x 2 log potentials between neighbours. With want_pairs also the expected moves.
    """
    row, column = _stretches(owner)
    rows = int(row[-1]) + 1 if len(row) else 0
    e = np.zeros((STRETCH, rows))
    real = np.zeros((STRETCH, rows), bool)
    e[column, row], real[column, row] = emission, True
    a, b = np.exp(move[:, 0]), np.exp(move[:, 1])  # to tag 0, to tag 1
    up = np.exp(np.clip(e, -30, 30))
    alpha = np.empty((STRETCH, rows))  # odds of tag 1 over the tokens so far
    last = None
    for t in range(STRETCH):
        odds = up[t] if t == 0 else up[t] * (b[0] + b[1] * last) / (a[0] + a[1] * last)
        last = alpha[t] = np.where(real[t], odds, 1.0)
    beta = np.ones((STRETCH, rows))
    for t in range(STRETCH - 2, -1, -1):
        after = up[t + 1] * beta[t + 1]
        beta[t] = np.where(real[t + 1], (a[1] + b[1] * after) / (a[0] + b[0] * after), 1.0)
    odds = alpha * beta
    p = (odds / (1 + odds))[column, row]
    if not want_pairs:
        return p
    pair = np.zeros((2, 2))
    both = real[1:]
    left, right = alpha[:-1][both], (up * beta)[1:][both]
    cells = np.stack([a[0] * np.ones_like(left), b[0] * right, a[1] * left, b[1] * left * right])
    pair[:] = (cells / cells.sum(0)).sum(1).reshape(2, 2)
    return p, pair


class Model:
    """Feature weights, moves, and the logistic model over a document's marginals."""

    def __init__(self):
        self.weights, self.bias = np.zeros(TABLE, np.float32), -4.0
        self.move = np.zeros((2, 2))
        self.document = np.array([-3.0, 1.0, 1.0, 0.0])

    def emission(self, features: np.ndarray) -> np.ndarray:
        total = np.full(len(features), self.bias, np.float64)
        for k in range(features.shape[1]):
            total += self.weights[features[:, k]]
        return total

    @staticmethod
    def summary(p: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """For each text: 1, log(1 + expected toxic tokens), greatest marginal, log(1 + tokens).

        Marginals under a tenth don't add up, or every long text would become toxic.
        """
        total, count, most = np.bincount(owner, np.where(p > 0.1, p, 0), texts), np.bincount(owner, minlength=texts), np.zeros(texts)
        np.maximum.at(most, owner, p)
        return np.stack([np.ones(texts), np.log1p(total), most, np.log1p(count) / 10], 1)

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, tuple]:
        features, owner, offset, length = tokens(texts)
        p = marginals(self.emission(features), owner, self.move)
        z = self.summary(p, owner, len(texts)) @ self.document
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), p, (owner, offset, length)


def token_labels(features: np.ndarray, owner: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Labels of tokens from labels of documents, by how their features divide among these."""
    marks = np.zeros(len(features), bool)
    many, few = max(1, toxic.sum()), max(1, (~toxic).sum())
    for k in range(features.shape[1] - 1):
        seen = np.unique(owner.astype(np.int64) * TABLE + features[:, k])
        feature, of_toxic = seen % TABLE, toxic[seen // TABLE]
        a, b = np.bincount(feature[of_toxic], minlength=TABLE), np.bincount(feature[~of_toxic], minlength=TABLE)
        odds = np.log((a + 0.5) / many) - np.log((b + 0.5) / few)
        share = many / (many + few)
        over = (a - (a + b) * share) / np.sqrt(np.maximum((a + b) * share * (1 - share), 1e-9))
        marks |= ((odds >= ODDS) & (over >= DEVIATIONS))[features[:, k]]
    return marks & toxic[owner]


def train(texts: list[bytes], toxic: np.ndarray, shift: float = 0.0, epochs: int = 4, seed: int = 8) -> Model:
    """Fits the field by Adagrad on the tokens' likelihood, then the documents' logistic model by Newton steps.

    shift: log-odds to add where the sample has more toxic documents than the labels at large.
    Without documents of both labels, the model is one that calls nothing toxic.
    """
    model = Model()
    if not len(texts) or toxic.all() or not toxic.any():
        return model
    features, owner, _, _ = tokens(texts)
    tags = token_labels(features, owner, toxic)
    gathered, moved, rng = np.full(TABLE, 1e-3), np.full((2, 2), 1e-3), np.random.default_rng(seed)
    bias_seen = 1e-3
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), 64):
            docs = np.sort(order[low : low + 64])
            own = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in docs])
            if not len(own):
                continue
            f, y, o = features[own], tags[own].astype(np.float64), owner[own]
            p, pairs = marginals(model.emission(f), o, model.move, True)
            row, _column = _stretches(o)
            joined = row[1:] == row[:-1]
            before, after = tags[own][:-1][joined].astype(int), tags[own][1:][joined].astype(int)
            seen = np.bincount(before * 2 + after, minlength=4).reshape(2, 2)
            slope = np.bincount(f.ravel(), np.repeat(y - p, f.shape[1]), TABLE) - 1e-4 * model.weights
            gathered += slope * slope
            model.weights += (0.3 * slope / np.sqrt(gathered)).astype(np.float32)
            bias_seen += (y - p).sum() ** 2
            model.bias += 0.3 * (y - p).sum() / np.sqrt(bias_seen)
            step = seen - pairs
            moved += step * step
            model.move += 0.1 * step / np.sqrt(moved)
    p = marginals(model.emission(features), owner, model.move)
    x, y = model.summary(p, owner, len(texts)), toxic.astype(np.float64)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (y - q) - 0.1 * w)
    w[0] += shift
    model.document = w
    return model


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", seed: str = "toxicity") -> tuple[list[bytes], np.ndarray, float]:
    """A bounded sample of labelled documents: about EACH_LABEL of each label, at most twice as many rows, and A_TEXT characters of each.

    Of longer texts PARTS stretches are taken, at hashed places all over the text.

    The third result is the log-odds by which labels at large are more often toxic than those sampled.

    Ids are sampled by hash at a rate set from each label's count, before they meet the texts;
    being about 2 * EACH_LABEL, whatever the table, they are broadcast, and texts don't shuffle.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__label")).distinct()
    counts = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    rate = [min(1.0, EACH_LABEL / counts.get(k, 1)) * 2**31 for k in (0, 1)]
    order = F.pmod(F.xxhash64(F.col("__id").cast("string"), F.lit(seed)), F.lit(2**31))
    ids = known.where(order < F.when(F.col("__label") == 1, rate[1]).otherwise(rate[0]))
    cut = stretch(docs[text], A_TEXT, F.col("__id").cast("string"), PARTS)
    met = docs.join(F.broadcast(ids), docs[doc_id] == ids["__id"]).select("__id", "__label", order.alias("__order"), cut.alias("t"))
    rows = first_rows(met, "__label", ["__order", "t"], 2 * EACH_LABEL).select("__id", "__label", "t").collect()
    rows = sorted(((r["__id"], r["__label"], r["t"] or "") for r in rows))
    shift = float(np.log(rate[0] / rate[1]))
    return [t.encode("utf-8", "replace") for _, _, t in rows], np.array([y == 1 for _, y, _ in rows], bool), shift


def score_documents(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """The columns `keep` of `docs` (default: all), score, predicted and spans, for every row.

    Columns that have the names of the new ones are replaced. spans are the tokens tagged toxic (marginal over one half), as (offset, length) in UTF-8
    bytes. Null and empty texts get the score of a text without tokens. Whole texts are
    tagged; the chain restarts every STRETCH tokens. The model is broadcast: about 1 MB.
    """
    from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

    columns = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted", "spans")]
    kept = docs.select(*[docs[c] for c in columns], docs[text].cast("string").alias(unused("__text", columns)))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [t or b"" for t in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]
            scores, spans, at = [], [], 0
            while at < len(own):
                end, size = at, 0
                while end < len(own) and (end == at or size + len(own[end]) <= AT_ONCE):
                    size += len(own[end])
                    end += 1
                score, p, (owner, offset, length) = sent.value.scores(own[at:end])
                found: list[list] = [[] for _ in range(end - at)]
                for i in np.flatnonzero(p > 0.5):
                    found[owner[i]].append([int(offset[i]), int(length[i])])
                scores.append(score)
                spans += found
                at = end
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                [*batch.schema.names[:-1], "score", "predicted", "spans"],
            )

    fields = [*kept.schema.fields[:-1], StructField("score", DoubleType()), StructField("predicted", IntegerType()), StructField("spans", ArrayType(ArrayType(LongType())))]
    return kept.mapInArrow(run, StructType(fields))
