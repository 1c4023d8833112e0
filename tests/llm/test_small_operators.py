"""Exact dedup, sharding, mixing, packing and embeddings, on odd rows and against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lexspan.llm import bloom, embedding_dedup, exact_dedup, mixing, numbering, packing, queries, sharding
from lexspan.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls in each column, empty and blank texts, ties, repeated rows, and a long text.
ODD = [
    (1, "Abc def", "en", "a", 7), (2, "aBC DEF", "en", "b", 7), (2, "aBC DEF", "en", "b", 7), (3, None, None, None, None), (4, "", "de", "a", 0),
    (5, " \n\t", "fr", "", 3), (6, "É é", "fr", "a", 3), (7, "é é", "fr", "a", 3), (None, "abc DEF", "en", "a", 7), (9, "w " * 30_000, "en", "z", 60_000),
    (-4, "one two three", "en", "b", 13), (2**62, "one two three four", "en", None, 18),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def crowded(docs):
    """Columns that operators use inside or return."""
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("x") for c in ("keep_id", "group_size", "kept", "text_sha256", "size", "shard", "slot", "position", "batch", "__slot", "__text", "score", "fingerprint", "node", "__digest", "__page0", "__id", "__position", "__goes", "row", "id", "f0")})


@pytest.mark.parametrize("name", ["op10_exact_dedup", "op9_mixing", "op1_suffix_dedup", "op4_embedding_dedup", "op5_substring_dedup"])
def test_query_equals_sql(compare, name):
    compare(queries.queries()[name], queries.oracle_sql()[name])


def test_sharding_equals_sql(compare):
    compare(queries.op6_sharding, queries.oracle_sql()["op6_sharding"])


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("most", [8192, 0])
def test_exact_groups(odd, most):
    groups = defaultdict(list)
    for r in ODD:
        groups[folded(r[1])].append(r[0])
    want = []
    for r in ODD:
        own = groups[folded(r[1])]
        keep = max((i for i in own if i is not None), default=None)
        want.append((r[0], keep, len(own), r[0] == keep, hashlib.sha256(folded(r[1]).encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_groups(crowded(odd), most_pages=most).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = crowded(odd)
    out = exact_dedup.exact_dedup(kept, most_pages=most)
    assert out.columns == kept.columns
    assert Counter(folded(r["text"]) for r in out.collect()) == Counter(groups.keys())


@pytest.mark.parametrize("most", [8192, 0])
def test_few_unique_rows_are_suspects_however_many_there_are(spark, most):
    """The filter grows with what is repeated, so it never fills up; half of all rows share one text."""
    hashed = spark.range(60_000).selectExpr("CASE WHEN id < 30000 THEN sha2('one', 256) WHEN id < 40000 THEN sha2(string(id % 5000), 256) ELSE sha2(string(id), 256) END AS text_sha256", "id")
    judged = exact_dedup._judged(hashed, most).selectExpr("__suspect", "id >= 40000 AS alone").groupBy("__suspect", "alone").count().collect()
    counts = {(r["__suspect"], r["alone"]): r["count"] for r in judged}
    assert counts[True, False] == 40_000 and (False, False) not in counts and counts.get((True, True), 0) < 400


def test_rows_that_go_and_rows_that_stay_once(spark):
    from pyspark.sql import functions as F

    docs = spark.range(2000).selectExpr("id % 1000 AS doc_id", "IF(id % 10 = 3, 'a', string(id)) AS text", "'x' AS __own", "'y' AS row")
    own, row = docs["doc_id"], F.xxhash64(docs["doc_id"], docs["text"])
    keys = docs.select(own.alias("__id"), row.alias("__row"), "text")
    goes, once = keys.where("__id % 10 = 5"), keys.where("text = 'a'")
    for most in (8192, 0):
        out = bloom.without(docs, own, row, goes, once, most)
        assert out.columns == docs.columns
        rows = Counter((r["doc_id"], r["text"]) for r in out.collect())
        assert sum(rows.values()) == 2000 - 200 - 100 and all(n == 1 for n in rows.values()) and sum(t == "a" for _, t in rows) == 100


def test_exact_empty(none):
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.exact_dedup(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1000])
def test_places_are_a_permutation(n):
    places = [sharding.place(i, n, 7) for i in range(n)]
    assert sorted(places) == list(range(n)) and [sharding.number(p, n, 7) for p in places] == list(range(n))


def test_shards(odd, none, spark, tmp_path):
    rows = sharding.shard_rows(crowded(odd), 5, 3).collect()
    n = len(ODD)
    assert sorted(r["row_number"] for r in rows) == list(range(n))
    for r in rows:
        at = sharding.place(r["row_number"], n, 3)
        assert (r["shard"], r["slot"]) == (at % 5, at // 5)
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted(
        (i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in ODD
    )
    assert sharding.shard_rows(none).count() == 0
    docs = spark.range(100).selectExpr("id doc_id", "concat('t', id) text")
    sharding.write_shards(docs, f"{tmp_path}/s", 4)
    assert Counter(r["__shard"] for r in spark.read.parquet(f"{tmp_path}/s").collect()) == {k: 25 for k in range(4)}
    # Repeated rows, null ids and texts, names that clash: each row is written once, in its own place.
    clash = crowded(odd).selectExpr("*", "'x' AS __shard", "1 AS __SLOT")
    sharding.write_shards(clash, f"{tmp_path}/odd", 5, 3)
    out = spark.read.parquet(f"{tmp_path}/odd").collect()
    assert sorted((r["__shard"], r["__slot"]) for r in out) == sorted((r["shard"], r["slot"]) for r in rows)
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((i, t) for i, t, *_ in ODD)
    sharding.write_shards(none, f"{tmp_path}/none")


def poured(sizes, weights, share=1.5, most=2.0):
    """Targets by resharing the excess over and over."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        over = 0.0
        for s in list(open_):
            target[s] += left * w[s] / total
            if target[s] >= most * sizes[s]:
                over += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
        left = over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_mixing_plan(spark, seed):
    r = random.Random(seed)
    rows = [(i, " ".join(["w"] * r.choice([0, 1, 5, 50])), r.choice(["a", "b", "é", None, "c", "A"] if seed else ["a"] * 9 + ["b"])) for i in range(200)]
    plan = mixing.mixing_plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want, taken = poured(sizes, (5, 2, 1)), Counter()
    for p in plan:
        taken[p["source"]] += p["taken"]
        assert p["target"] == pytest.approx(want[p["source"]]) and p["source_size"] == sizes[p["source"]] and 0 <= p["taken"] <= 2 * p["size"]
        assert sum(x["words"] for x in p["passes"]) == p["taken"] and all(0 <= x["position"] <= 1 for x in p["passes"])
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_mix(odd, none, spark):
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), "en", "ab"[i % 2], i) for i in range(60)], SCHEMA)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    copies = Counter(r["doc_id"] for r in out.collect())
    assert max(copies.values()) == 2 and mixing.mix(docs).collect() == out.collect()
    assert mixing.mix(crowded(docs)).columns == crowded(docs).columns and mixing.mix(crowded(docs)).count() == out.count()
    assert mixing.mix(none).count() == 0 and mixing.mixing_plan(none).count() == 0
    assert mixing.mixing_plan(crowded(odd)).count() == len(ODD)


def test_mix_of_repeated_and_null_ids(spark):
    """Every row is on its own, whatever its id: none comes out more often than the passes."""
    docs = [(None, f"text {k} without an id", "a") for k in range(30)] + [(7, f"text {k} of one id", "a") for k in range(30)] + [(8, "equal rows", "a")] * 5
    docs += [(100 + k, f"{k} other words here", "b") for k in range(100)]
    out = Counter(tuple(r) for r in mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect())
    rows = Counter(docs)
    assert set(out) <= set(rows) and all(n <= 2 * rows[k] for k, n in out.items())
    assert abs(sum(len(k[1].split()) * n for k, n in out.items()) - 1.5 * sum(len(t.split()) for _, t, _ in docs)) < 20


def test_running_totals(spark):
    rows = [(i, i % 3, None if i % 5 == 0 else "g") for i in range(300)]
    got = numbering.running_total(spark.createDataFrame(rows, "i long, v long, g string"), "i", ["i"], "v", "g", blocks=7).collect()
    for g in (None, "g"):
        own = sorted((r for r in got if r["g"] == g), key=lambda r: (r["i"] * 48271 % 2147483647 % 7, r["i"]))
        total = 0
        for r in own:
            assert r["__before"] == total
            total += r["v"]
        assert {r["__total"] for r in own} == {total}


def check_pieces(rows, texts, encode, size):
    """texts: list of (doc_id, text). Pieces must give back each document once."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
    wanted = defaultdict(list)
    for i, t in texts:
        wanted[i].append(np.array([*encode(t or ""), 1], "<u4"))
    assert set(by_doc) == set(wanted)
    for i, documents in wanted.items():
        assert sum(r["length"] for r in by_doc[i]) == sum(map(len, documents))
        if len(documents) == 1:
            at, ids = 0, documents[0]
            for r in sorted(by_doc[i], key=lambda r: r["start"]):
                assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
                at += r["length"]
    return sum(r["length"] for r in rows) / (size * len(by_sequence))


def test_packing_whole_table(spark):
    from conftest import SF

    pieces = queries.op2_packing(spark, SF)
    docs = queries.table(spark, SF, "documents")
    e = packing.encoder(queries.tokenizer_path()).tokenizer
    encode = lambda t: e.encode(t, add_special_tokens=False).ids
    fill = check_pieces(pieces.collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], encode, 2048)
    assert fill > 0.95
    sequences = packing.sequences(docs, pieces, queries.tokenizer_path())
    lengths = {r["sequence_id"]: r["n"] for r in pieces.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert {r["sequence_id"]: len(r["ids"]) for r in sequences.collect()} == lengths


def test_sequences_of_repeated_ids(odd):
    path = queries.tokenizer_path()
    pieces = packing.pack(odd, path, size=64, open_windows=2, pad=4)
    total = {r["sequence_id"]: r["n"] for r in pieces.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    got = {r["sequence_id"]: r["ids"] for r in packing.sequences(odd, pieces, path).collect()}
    assert {k: len(v) for k, v in got.items()} == total
    for r in pieces.collect():
        assert zlib.crc32(np.array(got[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]


def test_packing_odd(odd, none):
    e = packing.encoder(queries.tokenizer_path()).tokenizer
    rows = packing.pack(crowded(odd), queries.tokenizer_path(), size=64, open_windows=2, pad=4).collect()
    check_pieces(rows, [(r[0], r[1]) for r in ODD], lambda t: e.encode(t, add_special_tokens=False).ids, 64)
    assert packing.pack(none, queries.tokenizer_path()).count() == 0


def test_encoder_is_exact():
    r = random.Random(1)
    parts = ["a", "é", "Z", " ", "\n", "\t", "'s", ".", "1", "ß", "漢", " ", "\x1c", "'", "!", "ǅ", "ʰ", "𝒳", "\r\n", "<|endoftext|>", "\0", "Hello", ","]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    e = packing.Encoder(queries.tokenizer_path())
    want = [x.ids for x in e.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in e.batch(texts)] == want


def test_encoder_of_all_characters_and_long_texts(monkeypatch):
    e = packing.Encoder(queries.tokenizer_path())
    assert e.fast is not None
    exact = lambda texts: [x.ids for x in e.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    texts = ["".join(f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}{chr(c)} x" for c in range(low, low + 256) if not 0xD800 <= c <= 0xDFFF) for low in range(0, 0x20000, 256)]
    long = [" " * 1_500_000 + "x", "\n" * 900_000, "ab" * 600_000, "x  y " * 300_000, "one word after another\n" * 30_000]
    assert [np.frombuffer(x, "<u4").tolist() for x in e.batch(texts + long)] == exact(texts + long)
    monkeypatch.setattr(packing, "STRETCH", 7)
    assert [np.frombuffer(x, "<u4").tolist() for x in e.batch(texts)] == exact(texts)


def test_a_file_of_another_kind_goes_to_its_own_library():
    import public_tokenizers

    e = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert e.fast is None and np.frombuffer(e.encode("Some words, here"), "<u4").tolist() == e.tokenizer.encode("Some words, here", add_special_tokens=False).ids


def test_open_windows_are_bounded():
    w, r = packing.Windows(100, 4, 0), random.Random(2)
    closed = []
    for _ in range(500):
        n = r.randint(1, 100)
        closed += w.add(n, n, lambda p, k: (k, p - k))
        assert len(w.free) <= 4
    assert all(sum(c) == 100 for c in closed)


def roots_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize(("seed", "at_once"), [(0, 0), (1, 60), (2, 0), (0, 50_000), (1, 50_000)])
def test_components(spark, seed, at_once):
    """By steps to the end, by steps until few links are left, and in one task."""
    r = random.Random(seed)
    links = [(i, i + 1) for i in range(40)] + [(r.randrange(100), r.randrange(100)) for _ in range(40)]
    r.shuffle(links)
    found = connected_components(spark.createDataFrame([*links, (None, 3), (-5, 7), (2**40, 8)], "a long, b long"), "a", "b", at_once).collect()
    got = {x["node"]: x["root"] for x in found}
    assert len(found) == len(got) and got.pop(-5) == -5 and got.pop(2**40) == got[8]
    below = {i for i, root in got.items() if root == -5}  # what reaches 7
    assert 7 in below
    want = roots_of(100, links)
    linked = {i for a, b in links if a != b for i in (a, b)} | {7, 8}
    assert below == {i for i in linked if want[i] == want[7]}
    assert {i: root for i, root in got.items() if i not in below} == {i: want[i] for i in linked - below}


def test_components_without_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute_embeddings(rows):
    unit = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v, np.float64)
            unit[i] = (label, u / np.linalg.norm(u))
    links = [(a, b) for a in unit for b in unit if a < b and unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.98]
    ids = sorted(i for i, _, _ in rows)
    at = {i: k for k, i in enumerate(ids)}
    root = roots_of(len(ids), [(at[a], at[b]) for a, b in links])
    degree = Counter(i for pair in links for i in pair)
    return sorted((i, degree[i], ids[root[at[i]]], ids[root[at[i]]] == i) for i in ids)


def test_embeddings_whole_table(spark):
    from conftest import SF

    rows = [tuple(r) for r in queries.table(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    assert sorted(tuple(r) for r in queries.op4_embedding_dedup(spark, SF).collect()) == brute_embeddings(rows)


def test_embeddings_odd(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    r = np.random.default_rng(0)
    base = r.standard_normal((6, 16))
    rows = [(i, [float(x) for x in base[i % 6] + 0.04 * r.standard_normal(16)], i % 2) for i in range(150)]
    rows += [(200 + i, rows[0][1], 0) for i in range(30)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] * 16, 0), (303, [None] * 16, 0), (304, rows[0][1], None), (305, [1.0, 2.0], 0), (306, [2.0, 4.0], 0), (307, [], 0), (308, [float("inf")] * 16, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' AS class", "1 AS bucket", "2 AS node")
    exact = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]
    assert sorted(tuple(x) for x in embedding_dedup.embedding_dedup(df).collect()) == brute_embeddings(exact)
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


def near_copies(n, noise, dim=64, seed=1):
    r = np.random.default_rng(seed)
    centre = r.standard_normal(dim)
    return centre / np.linalg.norm(centre) + noise * r.standard_normal((n, dim)) / dim**0.5


def test_a_crowd_meets_once(spark):
    """Members that shared an earlier bucket aren't dealt again, and every pair of some bucket meets."""
    vectors = near_copies(6000, 0.02)
    df = spark.createDataFrame([(i, "a", v) for i, v in enumerate(vectors.tolist())], "class long, label string, embedding array<double>").repartition(4).cache()
    k, tables = embedding_dedup.tables_for(6000, 0.98)
    keyed = df.select("class", "embedding").mapInArrow(embedding_dedup._hash(k, tables, 4), "class long, keys array<long>")
    dealt = embedding_dedup._tasks(df.select("class", "label").join(keyed, "class"), 6000 * tables).cache()
    assert dealt.count() <= 20 * 6000  # 39 a vector if every crowd were dealt whole
    met, hashes = np.zeros((6000, 6000), bool), {r["class"]: r["keys"] for r in keyed.collect()}
    tasks = defaultdict(list)
    for r in dealt.collect():
        tasks[r["task"]].append((r["class"], r["side"]))
    for own in tasks.values():
        x, y = ([c for c, side in own if side != other] for other in (2, 1))
        met[np.ix_(x, y)] = met[np.ix_(y, x)] = True
    keys = np.array([hashes[i] for i in range(6000)])
    for t in range(tables):
        share = keys[:, t][:, None] == keys[:, t]
        assert met[share].all()
        if t == 3:
            break


def test_embeddings_with_links_equal_sql(spark):
    import duckdb

    rows = [(i, v, i % 2) for i, v in enumerate(near_copies(150, 0.12, 16).tolist())] + [(200 + i, v, 0) for i, v in enumerate(near_copies(60, 0.1, 16, 2).tolist())]
    rows += [(5, rows[7][1], 1), (300, None, 1), (301, [0.0] * 16, 1), (302, rows[3][1], None), (303, rows[3][1][:8], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    duck = duckdb.connect()
    frame = df.toPandas()  # noqa: F841  read by the SQL below
    duck.sql("CREATE TABLE embeddings AS SELECT * FROM frame")
    found = duck.execute(queries.oracle_sql()["op4_embedding_dedup"]).fetchall()
    assert sum(r[1] for r in found) > 1000
    assert sorted(map(tuple, found), key=repr) == sorted((tuple(r) for r in embedding_dedup.embedding_dedup(df).collect()), key=repr)


def test_filters_larger_than_a_broadcast_shuffle_no_rows(spark):
    """A filter of many broadcasts: whole rows stay where they are but for the suspects."""
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('text number ', if(id % 3 = 0, id % 5000, id)) AS text")
    out = exact_dedup.exact_dedup(docs, most_pages=1)
    plan = out._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert not any("__page" in line for line in plan.split("\n") if "Exchange hashpartitioning" in line or "RangePartitioning" in line)
    assert plan.count("BroadcastHashJoin") >= 2
    kept = {r["text"]: r["doc_id"] for r in out.collect()}
    want = {}
    for r in docs.collect():
        want[r["text"]] = max(r["doc_id"], want.get(r["text"], -1))
    assert kept == want


def test_embeddings_of_a_crowd(spark):
    """Thousands of vectors of one direction and others near it: links counted once each, no pair listed."""
    r = np.random.default_rng(5)
    base = r.standard_normal(16)
    rows = [(i, (base + (0.01 if i % 3 else 0.2) * r.standard_normal(16)).tolist(), "ab"[i % 2]) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {x["vec_id"]: tuple(x) for x in embedding_dedup.embedding_dedup(df).collect()}
    want, ids = {}, np.array([i for i, _, _ in rows])
    for k in "ab":
        own = ids[[y == k for _, _, y in rows]]
        u = np.array([rows[i][1] for i in own])
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        near = u @ u.T >= 0.98
        want |= dict(zip(own.tolist(), (near.sum(1) - 1).tolist(), strict=True))
    total = sum(want.values())
    assert total > 1_000_000 and sum(x[1] for x in got.values()) >= 0.998 * total and all(x[1] <= want[i] for i, x in got.items())
    found = embedding_dedup.embedding_links(df.selectExpr("vec_id AS class", "label", "1L AS copies", "embedding"), 3000)
    assert found.count() < 30 * 3000
