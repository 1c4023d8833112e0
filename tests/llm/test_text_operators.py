"""Suffix and substring dedup, SimHash, language, toxicity and the pipeline, against brute force."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from conftest import SF

import corpus_pipeline
from lexspan.llm import language_id, queries, repeats, simhash, substring_dedup, suffix_dedup, toxicity
from lexspan.llm.components import stars
from test_small_operators import ODD, SCHEMA, crowded, folded, roots_of

LARGEST = 2**63 - 1


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_removed(docs, length, units):
    """(id, units, removed, spans, hash of what is kept) of each (id, text)."""
    seqs = [(LARGEST if i is None else i, i, units((t or "").encode())) for i, t in docs]
    cut = lambda s, p: s[p : p + length] if isinstance(s, bytes) else tuple(s[p : p + length])
    first = {}
    for key, _, s in seqs:
        for p in range(len(s) - length + 1):
            w = cut(s, p)
            first[w] = min(first.get(w, LARGEST), key)
    out = []
    for key, i, s in seqs:
        gone = [False] * len(s)
        for p in range(len(s) - length + 1):
            if first[cut(s, p)] < key:
                gone[p : p + length] = [True] * length
        spans = sum(g and not b for g, b in zip(gone, [False, *gone], strict=False))
        kept = bytes(b for b, g in zip(s, gone, strict=True) if not g) if isinstance(s, bytes) else b" ".join(w for w, g in zip(s, gone, strict=True) if not g)
        out.append((i, len(s), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def collage(seed, n=40):
    r = random.Random(seed)
    words = [r.choice(["a", "b", "é", "zz", "the"]) * r.randint(1, 2) for _ in range(r.choice([2, 30]))]
    passages = [[r.choice(words) for _ in range(60)] for _ in range(3)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(0, 4)):
            p, a = r.choice(passages), r.randint(0, 40)
            parts += p[a : r.randint(a, 60)] if r.random() < 0.5 else [r.choice(words) for _ in range(r.randint(0, 80))]
        docs.append((i, r.choice([" ", "\n", "  "]).join(parts)))
    return docs


CASES = [(suffix_dedup.suffix_dedup, bytes, 50, "n_bytes"), (substring_dedup.substring_dedup, bytes.split, 13, "n_words")]


@pytest.mark.parametrize(("operator", "units", "length", "n"), CASES)
@pytest.mark.parametrize("hot", [4096, 8])
def test_repeats(spark, monkeypatch, operator, units, length, n, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "BATCH", 4000)
    docs = [(k * 1000 + i, t) for k in range(4) for i, t in collage(k)] + [(5, None), (None, collage(0)[3][1]), (3, collage(0)[3][1]), (3, collage(0)[3][1])]
    df = crowded(spark.createDataFrame([(i, t, None, None, None) for i, t in docs], SCHEMA))
    got = operator(df).select("doc_id", n, "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute_removed(docs, length, units)


@pytest.mark.parametrize(("operator", "units", "length", "n"), CASES)
def test_repeats_odd(odd, none, operator, units, length, n):
    got = operator(odd, with_content=True).collect()
    assert sorted(((r["doc_id"], r[n], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=repr) == brute_removed([(r[0], r[1]) for r in ODD], length, units)
    for r in got:
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and sum(b - a for a, b in r["spans"]) == r["n_removed"]
    assert operator(none).count() == 0


@pytest.mark.parametrize("name", ["op1_suffix_dedup", "op5_substring_dedup"])
def test_repeats_whole_table(spark, name):
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").collect()]
    got = queries.queries()[name](spark, SF)
    want = brute_removed(docs, 50, bytes) if name.startswith("op1") else [(i, n, g, h) for i, n, g, _, h in brute_removed(docs, 13, bytes.split)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_batches_do_not_depend_on_row_order():
    import pyarrow as pa

    docs = collage(1)
    one = [repeats.Batch(repeats.Bytes, pa.table({"doc_id": [i for i, _ in d], "text": [t for _, t in d]}), 50, 26) for d in (docs, docs[::-1])]
    assert np.array_equal(one[0].anchor, one[1].anchor) and np.array_equal(one[0].first, one[1].first)


def test_colliding_hashes_are_noticed():
    key, least = np.zeros(2, np.int64), np.array([1, 2])
    buffer = np.frombuffer(b"a" * 50 + b"b" * 50, np.uint8)
    s = suffix_dedup.Suffixes(buffer, 3)
    s.hash = lambda start, size: np.zeros(len(start), np.uint64)
    assert s.equal_to_previous(np.arange(2), np.array([0, 50]), np.array([50, 50]), key) is None
    assert suffix_dedup.match(key, buffer, np.array([0, 50, 100]), np.ones(2, np.int64), least, 50).tolist() == [0, 0]


def test_suffix_sort_is_a_sort():
    r = np.random.default_rng(0)
    buffer = r.integers(97, 99, 400).astype(np.uint8)
    start, size = r.integers(0, 350, 300), r.integers(1, 50, 300)
    group = np.sort(r.integers(0, 5, 300))
    order = suffix_dedup.Suffixes(buffer, 5).sort(start, size, group)
    got = [(group[i], buffer[start[i] : start[i] + size[i]].tobytes()) for i in order]
    assert got == sorted(got)


def test_matching_statistics():
    a = substring_dedup.SuffixAutomaton()
    a.add(list("abcabd"), 1)
    a.add(list("xabdab"), 2)
    assert list(a.matches(list("cabdabx"), 3)) == [(2, 1), (3, 1), (4, 2), (5, 2)]


def brute_print(text, words):
    from xxhash import xxh64_intdigest

    w = folded(text).encode().split()
    own = [b" ".join(w[k : k + words]) for k in range(max(1, len(w) - words + 1))] if w else []
    count = Counter(b for s in own for b in range(64) if xxh64_intdigest(s, 42) >> b & 1)
    return sum(1 << b for b in range(64) if count[b] * 2 > len(own))


def brute_simhash(docs, distance=4, words=4):
    prints = [brute_print(t or "", words) for _, t in docs]
    links = [(a, b) for a in range(len(docs)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= distance]
    root, least = roots_of(len(docs), links), {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], LARGEST))
    return sorted(((i, f"{prints[k]:016x}", least.get(root[k])) for k, (i, _) in enumerate(docs)), key=repr)


def test_simhash_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").collect()]
    assert sorted(map(tuple, queries.op3_simhash(spark, SF).collect()), key=repr) == brute_simhash(docs)


def test_simhash_odd(odd, none):
    got = simhash.simhash_groups(crowded(odd)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_simhash([(r[0], r[1]) for r in ODD])
    assert simhash.simhash_groups(none).count() == 0 and simhash.near_dedup(none).count() == 0


@pytest.mark.parametrize("count", [10, 10**5, 10**9])
def test_links_among_crowded_fingerprints(spark, count):
    r = random.Random(count)
    prints = {r.getrandbits(64) for _ in range(50)} | {sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for _ in range(400)}
    signed = [p - 2**64 if p >= 2**63 else p for p in sorted(prints)]
    layout = simhash.segments(count, 4)
    assert sum(w for _, w, _ in layout) == 64 and sum(r + 1 for *_, r in layout) == 5
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), count).collect()
    at = {p: k for k, p in enumerate(signed)}
    want = [(a, b) for a in range(len(signed)) for b in range(a) if ((signed[a] ^ signed[b]) & (2**64 - 1)).bit_count() <= 4]
    assert all(((x["a"] ^ x["b"]) & (2**64 - 1)).bit_count() <= 4 for x in links)
    assert roots_of(len(signed), [(at[x["a"]], at[x["b"]]) for x in links]) == roots_of(len(signed), want)


def test_stars():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 80, 60), r.integers(0, 80, 60)
    got = stars(np.r_[a, np.arange(100, 160)], np.r_[b, np.arange(101, 161)])
    linked = [*zip(a.tolist(), b.tolist(), strict=True), *((i, i + 1) for i in range(100, 160))]
    assert roots_of(161, got.tolist()) == roots_of(161, linked) and len(set(got[:, 1].tolist())) == len(got)
    assert len(stars(np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0


def edited(words, r, share):
    return [r.choice(["xx", "yy", "zz"]) + str(r.randrange(1000)) if r.random() < share else w for w in words]


def test_near_copies_go_and_clean_documents_stay(spark):
    r = random.Random(3)
    base = [[f"w{r.randrange(5000)}" for _ in range(300)] for _ in range(60)]
    docs = [(i, " ".join(b)) for i, b in enumerate(base)] + [(100 + 10 * i + k, " ".join(edited(b, r, 0.01))) for i, b in enumerate(base[:20]) for k in range(8)]
    out = simhash.near_dedup(crowded(spark.createDataFrame([(i, t, "en", "a", 1) for i, t in docs], SCHEMA)))
    got = {x["doc_id"] for x in out.collect()}
    stay = brute_near(docs)  # 65 rows: some copies are less than 0.8 similar to all others
    assert stay <= got and len(got - stay) <= 0.1 * (len(docs) - len(stay))


def brute_sets(texts, words=5):
    out = []
    for t in texts:
        w = folded(t).split()
        out.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))})
    return out


def brute_near(docs, similarity=0.8):
    """Ids that stay if the pairs with at least the similarity are linked."""
    sets = brute_sets([t for _, t in docs])
    links = [(a, b) for a in range(len(docs)) for b in range(a) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= similarity]
    root, least = roots_of(len(docs), links), {}
    for k, (i, _) in enumerate(docs):
        least[root[k]] = min(i, least.get(root[k], LARGEST))
    return set(least.values())


def changed(words, r, places):
    """Words with so many single ones changed, far enough apart that each changes five shingles."""
    out = list(words)
    for at in r.sample(range(10, len(words) - 10, 6), places):
        out[at] = f"new{r.randrange(10**6)}"
    return out


@pytest.mark.parametrize("count", [10, 2**24, 2**25, 2**28, 2**34])
def test_larger_tables_miss_no_more(count):
    """The chance that a pair at the threshold shares no bucket, over drawn pairs, for any size."""
    import pyarrow as pa

    wide, samples = simhash.samples_for(count, 0.8)
    r = np.random.default_rng(0)
    one = r.integers(0, 2, (800, 256), np.uint8)
    two = one.copy()
    for row in two:
        row[r.choice(256, 39, replace=False)] ^= 1
    prints = np.packbits(np.concatenate([one, two]), axis=1, bitorder="little").view(np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(1600)), *[pa.array(np.ascontiguousarray(prints[:, k])) for k in range(4)]], ["node", "f0", "f1", "f2", "f3"])
    own = {}
    for out in simhash._probes(iter([batch]), wide, samples):
        for bucket, node in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True):
            own.setdefault(node, set()).add(bucket)
    assert wide >= max(18, (count - 1).bit_length() - 6)
    assert np.mean([own[k].isdisjoint(own[800 + k]) for k in range(800)]) < simhash.MISS + 0.02


def test_recall_by_similarity(spark):
    """Pairs alone, so that no third text helps: at least nine in ten are found from the threshold on."""
    r = random.Random(9)
    docs = []
    for i in range(900):
        base = [f"w{r.randrange(50_000)}" for _ in range(300)]
        docs += [(10 * i, " ".join(base)), (10 * i + 1, " ".join(changed(base, r, (6, 4, 2)[i % 3])))]  # similarity 0.82, 0.87, 0.93
    sets = brute_sets([t for _, t in docs])
    pairs = [(docs[k][0], len(sets[k] & sets[k + 1]) / len(sets[k] | sets[k + 1])) for k in range(0, len(docs), 2)]
    stay = {x["doc_id"] for x in simhash.near_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 1)):
        own = [i for i, s in pairs if low <= s < high]
        assert len(own) > 200 and np.mean([i + 1 not in stay for i in own]) >= 0.9
    assert all(i in stay for i, _ in pairs)


def test_texts_below_the_similarity_stay(spark):
    r = random.Random(7)
    docs = []
    for i in range(40):
        base = [f"w{r.randrange(50_000)}" for _ in range(300)]
        docs += [(10 * i, " ".join(base)), (10 * i + 1, " ".join(changed(base, r, 7 + i % 4)))]  # similarity 0.79, 0.76, 0.74, 0.71
    assert brute_near(docs) == {i for i, _ in docs}
    out = simhash.near_dedup(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(x["doc_id"] for x in out.collect()) == sorted(i for i, _ in docs)


def test_near_copies_of_repeated_and_null_ids(spark):
    r = random.Random(8)
    base = [[f"w{r.randrange(50_000)}" for _ in range(200)] for _ in range(6)]
    text = [" ".join(b) for b in base]
    copy = [" ".join(changed(b, r, 1)) for b in base]
    # A null id loses to others, one of two null ids stays, a clean row outlives the copy with its id, equal rows are one.
    docs = [(None, copy[0]), (1, text[0]), (None, text[1]), (None, copy[1]), (2, text[2]), (3, copy[2]), (3, text[3]), (4, text[4]), (4, text[4]), (None, text[5])]
    out = [tuple(x) for x in simhash.near_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    assert Counter(i for i, _ in out) == Counter([1, 2, 3, 4, None, None])
    assert (3, text[3]) in out and (None, text[5]) in out


@pytest.mark.parametrize("block", [4096, 7])
def test_near_groups_equal_brute_force(spark, monkeypatch, block):
    """Crowds in which some pairs are similar enough only to others than the first, in one block and in several."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    r = random.Random(11)
    docs = []
    for i in range(4):
        base = [f"w{r.randrange(50_000)}" for _ in range(300)]
        far = [changed(base, r, 8) for _ in range(6)]
        group = [base, *far, *[changed(f, r, 1) for f in far for _ in range(3)], *[changed(base, r, 1) for _ in range(8)]]
        docs += [(100 * i + k, " ".join(g)) for k, g in enumerate(r.sample(group, len(group)))]
    same = "one line again and again " * 60
    docs += [(1000, same + "alpha beta gamma delta epsilon zeta eta"), (1001, same + "seven other words come at this end")]  # much alike by count, 0.3 as sets
    out = simhash.near_dedup(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {x["doc_id"] for x in out.collect()} == brute_near(docs)


def test_languages(spark, none):
    rows = queries.op7_language_id(spark, SF).collect()
    lang = {r["doc_id"]: r["lang"] for r in queries.table(spark, SF, "documents").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts(odd, none):
    texts = {"en": ["the cat and the dog of this house with that"], "de": ["der hund und die katze aus dem haus mit einem"]}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(crowded(odd), texts).collect()}
    assert got[3] == got[4] == got[5] == ("und", 0.0) and got[1][0] in texts
    assert {r["lang_pred"] for r in language_id.identify(odd, {}).collect()} == {"und"}
    signs = odd.sparkSession.createDataFrame([(k, t) for k, t in enumerate(["²", "½①", "Ⅷ", "12 _ %", "²a", "漢", "ª"])], "doc_id long, text string")
    judged = {r["doc_id"]: r["lang_pred"] == "und" for r in language_id.identify(signs, texts).collect()}
    assert [judged[k] for k in range(7)] == [True, True, True, True, False, False, False]
    assert {r["doc_id"] for r in language_id.with_letters(signs).collect()} == {4, 5, 6}
    assert language_id.identify(none, texts).count() == 0 and language_id.references(none) == {}


def test_languages_of_large_scripts():
    """Scripts of thousands of characters, in and beyond the first plane, next to Latin ones."""
    r = random.Random(2)
    scripts = {"en": range(97, 123), "x": range(0x4E00, 0x5A00), "y": range(0x5A00, 0x6600), "z": range(0x20000, 0x20C00)}
    common = {k: [[chr(r.choice(s)) for _ in range(r.randint(2, 5))] for _ in range(1500)] for k, s in scripts.items()}
    text = lambda k, n: "".join(c for _ in range(n) for c in r.choice(common[k]))
    parser = language_id.Parser({k: [text(k, 300) for _ in range(10)] for k in scripts})
    truth = [k for k in scripts for _ in range(50)]
    found = parser.bits([text(k, 20) for k in truth]).argmin(1)
    assert [parser.langs[i] for i in found] == truth


def test_rare_characters_parse_like_common_ones():
    """Phrases counted by hand over more characters than have a column, and those no reference has."""
    r = random.Random(4)
    letters = [chr(0x4E00 + k) for k in range(200)]
    reference = "".join(r.choice(letters) for _ in range(3000))
    parser = language_id.Parser({"a": [reference]})

    def phrases(t):
        n = at = 0
        while at < len(t):
            size = 1
            while at + size < len(t) and t[at : at + size + 1] in reference:
                size += 1
            n, at = n + 1, at + size
        return n

    texts = [reference[k : k + 7] + r.choice(letters) + reference[3 * k : 3 * k + 20] + "?" * (k % 3) + "\U00020000" for k in range(60)]
    got = parser.bits(texts)[:, 0] * [len(t) for t in texts] / parser.cost[0]
    assert got.round().astype(int).tolist() == [phrases(t) for t in texts]


def test_cross_parsing_counts_phrases():
    parser = language_id.Parser({"a": ["abcab"]})
    phrases = lambda t: round(float(parser.bits([t])[0, 0]) * len(t) / parser.cost[0])
    assert [phrases(t) for t in ("abcab", "abab", "xx", "cabc", "a" * 256)] == [1, 2, 2, 2, 256]


def test_marginals_equal_enumeration():
    r = np.random.default_rng(0)
    emission, owner, move = r.standard_normal(9), np.array([0, 0, 0, 0, 1, 1, 2, 2, 2]), r.standard_normal((2, 2))
    got, pairs = toxicity.marginals(emission, owner, move, True)
    want, moves = np.zeros(9), np.zeros((2, 2))
    for text in range(3):
        own = np.flatnonzero(owner == text)
        total = 0.0
        p, m = np.zeros(len(own)), np.zeros((2, 2))
        for tags in product((0, 1), repeat=len(own)):
            w = np.exp(sum(emission[own] * tags) + sum(move[a, b] for a, b in zip(tags[:-1], tags[1:], strict=True)))
            total += w
            p += w * np.array(tags)
            for a, b in zip(tags[:-1], tags[1:], strict=True):
                m[a, b] += w
        want[own] = p / total
        moves += m / total
    assert np.allclose(got, want) and np.allclose(pairs, moves)


def toxic_corpus(n=600, seed=0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        words, toxic = [f"w{r.randrange(300)}" for _ in range(r.randint(20, 200))], i % 5 == 0
        for k in r.sample(range(len(words)), 4) if toxic else []:
            words[k] = r.choice(["Scumbag", "idiot,", f"vequ{r.randrange(50)}"])
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_toxicity_held_out_and_offsets(spark, odd, none):
    rows = toxic_corpus()
    docs, labels = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows if i % 2], "doc_id long, toxic int")
    model = toxicity.train(*toxicity.training_rows(docs, labels))
    judged = toxicity.score_documents(docs, model).collect()
    truth = {i: (t, y) for i, t, y in rows}
    held = [(r["predicted"], truth[r["doc_id"]][1]) for r in judged if r["doc_id"] % 2 == 0]
    assert np.mean([p == y for p, y in held]) > 0.97
    for r in judged:
        assert 0 <= r["score"] <= 1
        for at, n in r["spans"]:
            assert truth[r["doc_id"]][0].encode()[at : at + n].decode().lower().startswith(("scum", "idiot", "vequ"))
    scored = toxicity.score_documents(crowded(odd), model).collect()
    assert len(scored) == len(ODD) and all(r["predicted"] == 0 for r in scored)
    assert toxicity.score_documents(none, model).count() == 0
    empty = toxicity.train(*toxicity.training_rows(none, labels.limit(0)))
    assert all(r["predicted"] == 0 for r in toxicity.score_documents(odd, empty).collect())


def test_toxicity_query(spark):
    """The query's scores of the whole table, by forward and backward sums written out."""
    docs, labels = queries.table(spark, SF, "documents").select("doc_id", "text"), queries.table(spark, SF, "labels")
    model = toxicity.train(*toxicity.training_rows(docs, labels.where(language_id.fold("doc_id", 5) != 0)))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = queries.op8_toxicity(spark, SF).collect()
    assert len(rows) == len(texts)
    move = np.exp(model.move)
    for r in rows:
        features, *_ = toxicity.tokens([texts[r["doc_id"]].encode()])
        p = []
        for low in range(0, len(features), toxicity.STRETCH):
            weight = np.stack([np.ones(len(features[low : low + toxicity.STRETCH])), np.exp(np.clip(model.emission(features[low : low + toxicity.STRETCH]), -30, 30))], 1)
            forward, backward = [weight[0]], [np.ones(2)]
            for w in weight[1:]:
                forward.append((f := forward[-1] @ move * w) / f.sum())
            for w in weight[:0:-1]:
                backward.append((b := move @ (w * backward[-1])) / b.sum())
            both = np.array(forward) * np.array(backward[::-1])
            p += (both[:, 1] / both.sum(1)).tolist()
        p = np.array(p)
        z = np.array([1, np.log1p(p[p > 0.1].sum()), p.max(initial=0), np.log1p(len(p)) / 10]) @ model.document
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), abs=1e-6) and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and len(r["spans"]) == (p > 0.5).sum()


def test_language_query(spark):
    """The query's languages of the whole table, by substring searches in the references."""
    docs = queries.table(spark, SF, "documents").select("doc_id", "text", "lang")
    references = language_id.references(docs.where(language_id.fold("doc_id", 4) != 2))
    folded = {k: "\0".join(t.lower() for t in own) for k, own in references.items()}
    cost = {k: np.log2(2 + sum(map(len, own))) for k, own in references.items()}

    def phrases(text, reference):
        n = at = 0
        while at < len(text):
            size = 1
            while at + size < len(text) and text[at : at + size + 1] in reference:
                size += 1
            n, at = n + 1, at + size
        return n

    rows = {r["doc_id"]: r for r in queries.op7_language_id(spark, SF).collect()}
    checked = 0
    for d in docs.collect():
        text, r = d["text"], rows[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2)
        if not text or not language_id.has_letter(text):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        elif len(text) < 6000:
            text = text.lower()
            bits = {k: cost[k] * sum(phrases(text[low : low + 256], own) for low in range(0, len(text), 256)) / len(text) for k, own in folded.items()}
            assert r["lang_pred"] == min(sorted(bits), key=bits.get)
            assert r["score"] == pytest.approx(1 / sum(2 ** (-4 * (b - min(bits.values()))) for b in bits.values()), rel=1e-6)
            checked += 1
    assert checked > 150


def test_training_samples_are_bounded_and_from_whole_texts(spark):
    """Long texts are sampled beyond their beginnings; a label whose rows share an id is bounded all the same."""
    long = "a" * 50_000 + "b" * 50_000
    docs = spark.range(400).selectExpr("id AS doc_id", f"if(id % 2 = 0, repeat('a', 50000) || repeat('b', 50000), 'short ' || id) AS text", "'en' AS lang")  # noqa: F541
    texts = language_id.references(docs)["en"]
    assert sum(map(len, texts)) <= language_id.REFERENCE and all(len(t) <= language_id.A_TEXT for t in texts)
    assert any(set(t) == {"b"} for t in texts) and all(t in long or t.startswith("short ") for t in texts)
    same = spark.range(30_000).selectExpr("7L AS doc_id", "'some text ' || id AS text", "'en' AS lang")
    assert 0 < sum(map(len, language_id.references(same).get("en", [""]))) <= language_id.REFERENCE or not language_id.references(same)
    labels = spark.range(400).selectExpr("id AS doc_id", "int(id % 4 = 0) AS toxic")
    sample, toxic, _ = toxicity.training_rows(docs, labels)
    assert len(sample) == 400 and max(map(len, sample)) <= toxicity.A_TEXT + toxicity.PARTS and all({97, 98} <= set(t) for t in sample if len(t) > 1000)
    short = next(t for t in sample if len(t) < 1000)
    assert short.startswith(b"short ")
    rows = toxicity.training_rows(same, spark.range(20_000).selectExpr("7L AS doc_id", "1 AS toxic"))[0]
    assert len(rows) <= 2 * toxicity.EACH_LABEL


def test_the_pipeline_uses_the_shared_folder(spark):
    from lexspan.llm.common import shared_folder

    assert corpus_pipeline._folder(spark).startswith(shared_folder(spark))


def test_pipeline_stages(spark, tmp_path):
    """Each stage on its own input: what it must drop, what it must keep, and its columns."""
    r = random.Random(5)
    base = [[f"w{r.randrange(9000)}x" for _ in range(200)] for _ in range(40)]
    rows = [(i, " ".join(b), "en", "ab"[i % 2], 1) for i, b in enumerate(base)]
    rows += [(100 + i, " ".join(base[i]).upper(), "en", "a", 1) for i in range(10)]
    rows += [(200 + i, " ".join([*base[i][:100], f"edit{i}", *base[i][101:]]), "en", "b", 1) for i in range(10)]
    rows += [(300, None, "en", "a", 0), (301, "12 34 !!", "en", "a", 0), (302, "", None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = [x["doc_id"] for x in docs.collect()]
        assert name == "packing" or docs.columns == columns
    assert sorted(seen["language_id"]) == sorted(i for i, *_ in rows if i < 300)
    assert sorted(seen["exact_dedup"]) == sorted([*range(10, 40), *range(100, 110), *range(200, 210)])
    near = set(seen["simhash_dedup"])
    assert set(range(10, 40)) <= near and len(near) <= 42  # upper case changed nothing, so the copies and the edits meet
    assert set(seen["mixing"]) <= near and max(Counter(seen["mixing"]).values()) <= 2
    assert set(seen["packing"]) == set(seen["mixing"])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(x["doc_id"] for x in out.collect()) == Counter(seen["packing"])


def test_pipeline_of_nothing(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
