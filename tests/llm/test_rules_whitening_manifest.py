"""Quality rules, whitening and the Merkle manifest, against brute force and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction
from math import comb

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from lexspan.llm import merkle, quality, queries, whitening

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "Abc def\nAbc def\n", "en", "a", 7), (2, "x\ny", "en", "b", 7), (2, "x\ny", "en", "b", 7), (2, "z", None, "b", 1), (3, None, None, None, None),
    (4, "", "de", "a", 0), (None, "a # b", "en", "a", 7), (None, None, None, None, None), (5, "one two three " * 30, "fr", "", 3), (9, "w " * 30_000 + "\n\n", "en", "z", 60_000),
    (-4, "é " * 25, "en", "é", 13), (2**62, "| $ " * 20, "en", "=", 18),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in ("n_words", "kept", "rule", "__stratum", "r", "leaf", "g", "pos", "key", "claimed", "row", "whitened", "DEVIATION", "__vector", "vector", "digest", "height")})


# --- quality rules


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(lines)


@pytest.mark.parametrize("size", [7, 1 << 20])
def test_counts_of_random_texts(monkeypatch, size):
    monkeypatch.setattr(quality, "SLICE", size)
    r = random.Random(size)
    for _ in range(800):
        text = "".join(r.choice(["a", "b", "é ", "a ", "b ", "\n", "\t", "\x85", " ", "#", "\r\n"]) for _ in range(r.randint(0, 200)))
        assert quality.counts_of(text.encode()) == brute_counts(text)


def test_long_text_in_linear_time():
    text = b"some words that come again and again, " * 80_000  # three megabytes
    assert quality.counts_of(text)[:5] == (560_000, 31 * 80_000, 0, 0, 560_000)


@pytest.mark.parametrize("risk", [0.02, 0.3])
def test_bounds_are_exact(risk):
    p = Fraction(risk)
    for n in (1, 5, 40, 149, 250):
        for error in (0.05, 0.0125, 1e-6):
            total, want = Fraction(0), -1
            for k in range(n + 1):
                total += comb(n, k) * p**k * (1 - p) ** (n - k)
                if total > error:
                    break
                want = k
            assert quality.most_rejected(n, risk, error) == want
    assert quality.most_rejected(10**7, 0.02, 0.01) == pytest.approx(0.02 * 10**7 - 2.326 * (0.02 * 0.98 * 10**7) ** 0.5, abs=30)


def test_rules_query(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op11_quality(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        want = brute_counts(docs[r["doc_id"]]["text"])
        assert tuple(r[c] for c in quality.COUNTS[:5]) == want[:5]
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r["base_failed"] and r["kept"])


def made_up(spark, n, strata=2):
    """Good texts of plain words, one in forty with symbols; bad ones with symbols; each its own words."""
    rows, labels = [], []
    for i in range(n):
        good = i % 5 > 0
        mark = "###" if not good or i % 100 in (1, 2) else ""
        rows.append((i, " ".join(f"w{i}x{k}{mark}" for k in range(30)), f"l{i % strata}"))
        labels.append((i, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_cutoffs_hold_the_risk(spark):
    docs, labels = made_up(spark, 4000)
    got = quality.quality_rules(docs, labels, risk=0.05).join(labels, "doc_id")
    shares = {r["quality"]: r["kept"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[0] == 0 and shares[1] >= 0.95
    # The marks stand on one good text in forty, which is more than one in a hundred.
    assert quality.quality_rules(docs, labels, risk=0.01).where("NOT kept AND rule = 'symbols'").count() == 0
    # With few labels nothing can be bounded, so nothing is rejected; nor without any.
    assert quality.quality_rules(docs, labels.where("doc_id < 100"), risk=0.05).where("NOT kept").count() == 0
    assert quality.quality_rules(docs, labels.where("false")).where("NOT kept").count() == 0
    # Repeated rows and labels count once, contradicting labels not at all.
    twice = quality.quality_rules(docs.unionByName(docs), labels.unionByName(labels), risk=0.05)
    assert twice.where("kept").count() == 2 * got.where("kept").count()
    both = labels.unionByName(labels.selectExpr("doc_id", "1 - quality AS quality"))
    assert quality.quality_rules(docs, both, risk=0.05).where("NOT kept").count() == 0


def test_false_rejections_by_brute_force(spark):
    """The last step of each stratum, from the holdout's own rows."""
    docs, labels = made_up(spark, 3000, 3)
    counted = quality.with_counts(docs.select("doc_id", F.concat(F.lit("="), "lang").alias("__stratum"), "text"), "text", ["doc_id", "__stratum"])
    rules = quality.fit_rules(counted, labels, risk=0.05)
    steps = {r["__stratum"]: (r["__n"], r["__steps"]) for r in rules.steps.collect()}
    fits = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality")), F.lit(quality.FOLDS)) == 0
    hold = counted.join(labels.where("quality = 1"), "doc_id").where(~fits & ~quality.base_failed()).select("__stratum", rules.step().alias("step")).collect()
    for stratum in ("=l0", "=l1", "=l2"):
        own = [r["step"] for r in hold if r["__stratum"] == stratum]
        want = 0
        for k in range(len(rules.path)):
            if quality.binomial_cdf(sum(s is not None and s <= k for s in own), len(own), 0.05) <= 0.05 / 3:
                want = k + 1
            else:
                break
        assert steps.get(stratum, (len(own), 0)) == (len(own), want)
    # Steps and their rules: the first on the path that rejects a row.
    values = quality.statistics()
    for r in counted.select(rules.step().alias("step"), *[v.alias(n) for n, v in values.items()]).limit(200).collect():
        assert r["step"] == next((k for k, (rule, cut) in enumerate(rules.path) if r[rule] is not None and r[rule] >= cut), None)


def test_rules_on_odd_rows(odd, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (9, None), (5, 7)], "doc_id long, quality int")
    rows = quality.quality_rules(clashing(odd), clashing(labels)).collect()
    assert len(rows) == len(ODD)
    assert Counter(tuple(r[c] for c in ("doc_id", *quality.COUNTS)) for r in rows) == Counter((i, *brute_counts(t)) for i, t, *_ in ODD)
    assert quality.quality_rules(odd.where("false"), labels).count() == 0


# --- whitening


def test_whitening_equals_brute_force(spark):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids = sorted(vectors)
    x = np.floor(np.array([vectors[i] for i in ids], float) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    want = centred @ axes[:, :8] / np.sqrt(values[:8])
    rows = queries.op12_whitening(spark, SF).collect()
    assert len(rows) == 8 * n and len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9
    got = np.zeros((n, 8))
    for r in rows:
        at, k = ids.index(r["vec_id"]), r["component"] - 1
        got[at, k] = r["whitened"]
        assert r["n"] == n and r["deviation"] == sum(int(v) ** 2 for v in n * x[at] - sums)
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
    signs = np.sign((got * want).sum(0))
    assert np.abs(got * signs - want).max() < 1e-8


def test_tree_of_many_parts(spark):
    """More than sixteen partitions twice over, so that R factors are merged on three levels."""
    r = np.random.default_rng(3)
    x = (r.standard_normal((2000, 5)) @ r.standard_normal((5, 5))).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "id long, v array<double>")
    one, many = whitening.fit(df.coalesce(1), "v", 5), whitening.fit(df.repartition(300), "v", 5)
    assert np.array_equal(one.sums, many.sums) and np.allclose(one.eigenvalues, many.eigenvalues, rtol=1e-12) and np.allclose(one.vectors, many.vectors, atol=1e-9)
    assert whitening.identity_error(df.repartition(300), many, "v") < 1e-10


def test_whitening_on_odd_rows(spark):
    rows = [
        (1, [1.0, 2.0, 0.5]), (2, None), (3, [1.0, None, 2.0]), (4, [float("nan"), 1.0, 1.0]), (5, [float("inf"), 0.0, 0.0]), (6, []), (7, [1.0, 2.0]),
        (8, [0.0, 0.0, 0.0]), (8, [0.0, 0.0, 0.0]), (None, [3.0, -1.0, 2.0]), (9, [1e300, 0.0, 0.0]), (10, [-2.0, 7.0, 1e-9]),
    ]
    df = clashing(spark.createDataFrame(rows, "id long, v array<double>"))
    model = whitening.fit(df, "v")
    assert model.n == 5 and model.vectors.shape == (3, 3)
    out = whitening.whiten(df, model, "v")
    assert out.columns == [c for c in df.columns if c.lower() not in ("whitened", "deviation")] + ["whitened", "deviation"]
    assert sorted(r["id"] or 0 for r in out.collect()) == [0, 1, 8, 8, 10]
    assert whitening.fit(df.where("id IN (2, 3, 4)"), "v") is None and whitening.whiten(df, None, "v").count() == 0
    # Equal vectors span nothing, vectors on a line one component.
    flat = whitening.fit(df.where("id = 8"), "v")
    assert flat.n == 2 and len(flat.eigenvalues) == 0 and [r["whitened"] for r in whitening.whiten(df.where("id = 8"), flat, "v").collect()] == [[], []]
    assert whitening.identity_error(df.where("id = 8"), flat, "v") == 0
    line = spark.range(50).selectExpr("id", "array(double(id), double(2 * id), double(0)) AS v")
    assert len(whitening.fit(line, "v").eigenvalues) == 1
    # Beyond 64 bits the sums of squares are null, all others exact.
    far = spark.createDataFrame([(k, [2.0**29 * (k == 0), float(k)]) for k in range(4)], "id long, v array<double>")
    model = whitening.fit(far, "v")
    x = np.array([[int(2.0**29 * 1024) * (k == 0), 1024 * k] for k in range(4)], object) + 100_000
    want = [sum(int(v) ** 2 for v in 4 * row - x.sum(0)) for row in x]
    assert [r["deviation"] for r in whitening.whiten(far, model, "v").orderBy("id").collect()] == [v if v < 2**63 else None for v in want]


# --- Merkle manifest


def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(nodes):
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, j in zip(paths, own, strict=True):
            run = nodes[j // 3 * 3 : j // 3 * 3 + 3]
            path.append((j % 3, run[: j % 3] + run[j % 3 + 1 :]))
        nodes = [hashed("".join(nodes[k : k + 3])) for k in range(0, len(nodes), 3)]
        own = [j // 3 for j in own]
    return nodes[0], paths


def brute_manifest(rows, tamper=True):
    code = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        new = text.replace("\n", "") if tamper and text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 else text
        leaf, claimed = (hashed("".join(map(code, (doc_id, source, lang, n_chars, t)))) for t in (text, new))
        groups.setdefault(source, []).append((doc_id, leaf, claimed))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = brute_tree([r[1] for r in groups[s]])
    root, above = brute_tree([trees[s][0] for s in names])
    out = []
    for s, upper in zip(names, above, strict=True):
        for (doc_id, leaf, x), path in zip(groups[s], trees[s][1], strict=True):
            for at, others in path + upper:
                x = hashed("".join([*others[:at], x, *others[at:]]))
            out.append((doc_id, leaf, trees[s][0], root, hashed("".join(d for _, others in path + upper for d in others)), x, x == root))
    return sorted(out, key=repr)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merkle_query_equals_sql(compare):
    compare(queries.op13_merkle, queries.oracle_sql()["op13_merkle"])


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27, 28, 81, 100, 243])
def test_traversal(n):
    leaves = [hashed(str(k)) for k in range(n)]
    root, paths = brute_tree(leaves)
    height = next(k for k in range(9) if 3**k >= n)
    assert merkle.block_root(leaves, height) == root
    got = list(merkle.traverse(leaves, height))
    assert got == paths and all(merkle.fold(x, p) == root and merkle._path(merkle._text(p)) == p for x, p in zip(leaves, got, strict=True))


def test_memory_of_a_traversal_is_logarithmic():
    """Digests held at once beside the leaves: a run, a stack a level."""
    tree = merkle.TreeHash(6)
    most = 0
    for k in range(700):
        tree.push(hashed(str(k)))
        most = max(most, sum(map(len, tree.open)))
    assert most <= 2 * 6 + 1


def test_manifest_of_odd_rows(odd):
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"))).otherwise(F.col("text"))
    claimed = merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    assert plain(merkle.merkle_manifest(clashing(odd), queries.LEAF_VALUES, claimed=claimed)) == brute_manifest(ODD)
    for n in (0, 1):
        few = ODD[:n]
        got = plain(merkle.merkle_manifest(odd.limit(0) if not n else odd.where("doc_id = 1"), queries.LEAF_VALUES))
        assert got == brute_manifest(few, False) if n else got == []


def test_a_hot_group_takes_many_blocks_and_proofs_check(spark):
    rows = [(k, f"text {k % 50}", "en", "hot" if k % 3 else f"s{k % 40}", k) for k in range(2600)] + [(None, "x", None, None, None)] * 5
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    made = merkle.merkle_manifest(docs, queries.LEAF_VALUES, with_proof=True).cache()
    assert plain(made.drop("proof")) == brute_manifest(rows, False)
    assert made.where(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    assert made.where(merkle.folded(F.sha2("leaf", 256), F.col("proof")) == F.col("root")).count() == 0
