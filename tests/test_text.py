import pytest
from pyspark.sql import functions as F

from lexspan.functions import text as T
from lexspan.operators.scoring import CompiledQuery, unique_queries
from lexspan.plans.service import valid_alternates


@pytest.mark.parametrize(
    ("given", "expected"),
    [("État", "etat"), ("ﬁn", "fin"), ("İ", "i"), ("ΟΔΟΣ", "οδος"), ("łß", "łß"), (None, ""), ("", ""), ("ℌ", "H"), ("Aͅ", "aͅ".replace("ͅ", ""))],
)
def test_normalise(given, expected):
    assert T.normalise_text(given) == expected


def test_query_terms():
    assert T.query_terms("The EU law, the space-law of_x!") == ["the", "law", "the", "space-law", "of_x"]
    assert T.query_terms(None) == []


def test_clean_text_collapses_all_white_space_but_next_line(spark):
    text = " a ﻿\tb　 c\u0085d \n"
    assert spark.createDataFrame([(text,), (None,)], "t string").select(T.clean_text(F.col("t"))).collect() == [("a b c\u0085d",), ("",)]


def test_counts_do_not_overlap(spark):
    df = spark.createDataFrame([("aaaaa", "aa"), ("flaw law", "law"), ("x", "")], "t string, w string")
    assert [r[0] for r in df.select(T.count_occurrences(F.col("t"), F.col("w"))).collect()] == [2, 2, 0]


def test_golden_score(spark):
    row = ("The Italian space law of Italy. Space law.", "02_LAW/Italy/x.pdf Italy")
    df = spark.createDataFrame([tuple(map(T.normalise_text, row))], "content_norm string, path_norm string")
    q = CompiledQuery("Italy space law")
    assert df.select(q.score, q.matched_terms).first() == (116, ["italy", "space", "law"])


@pytest.mark.parametrize(("query", "content", "score"), [
    ("the", "the the the", None), ("the the", "the", 1 * 8 * 2 + 24 + 40), ("EU UK", "eu uk", None), ("", "x", None),
    ("italy italia", "nothing", None), ("abc def", "abc def", 16 + 24 + 40 + 35), ("abc de", "abc de", None),
])
def test_gate(spark, query, content, score):
    df = spark.createDataFrame([(content, "italy italia")], "content_norm string, path_norm string")
    assert df.select(CompiledQuery(query).score).first()[0] == score


def test_phrase_must_be_longer_than_six(spark):
    df = spark.createDataFrame([("abc xyz", "")], "content_norm string, path_norm string")
    assert df.select(CompiledQuery("abc xyz").phrase_bonus, CompiledQuery("ab xyz").phrase_bonus).first() == (35, 0)


def test_driver_side_arguments():
    assert unique_queries(["The", " the ", 5, "", "État", "etat"]) == ["The", "État"]
    assert unique_queries("x") == ["x"]
    assert len(unique_queries([str(i) for i in range(20)])) == 8
    assert valid_alternates([" a ", "", 3, *"bcdefghij"]) == list("abcdefg")
    assert valid_alternates("abc") == []
    assert [T.clamp_int(v, 8, 1, 50) for v in ("5abc", "x", None, 99, -3, 7.9)] == [5, 8, 8, 50, 1, 7]
    assert T.requested_file(" a\\b ") == "a/b"
    assert T.url_path("a b\\c+é(1).pdf") == "a%20b/c%2B%C3%A9(1).pdf"
    assert T.percent_decode("a%20b%C3%A9") == "a bé"
    assert T.percent_decode("50%") == "50%" and T.percent_decode("%FF") == "%FF"


@pytest.mark.parametrize("text", ["a b/é+%.pdf", "x!~*'()/-_.\\y", "100%", "%zz", "%C3%A9", "%C3", "%EF%BF%BD", "%C3%EF%BF%BD", "%-1", "%+1", "a+b", "", "%00", "\ufffd%41", "😀/ł"])
def test_url_columns_equal_their_scalars(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(T.url_path_of(F.col("t")), T.percent_decoded(F.col("t")), T.percent_decoded(T.url_path_of(F.col("t")))).first()
    assert tuple(row) == (T.url_path(text), T.percent_decode(text), text.replace("\\", "/"))


def test_url_columns_of_null(spark):
    assert spark.createDataFrame([(None,)], "t string").select(T.url_path_of(F.col("t")), T.percent_decoded(F.col("t"))).first() == (None, None)


def test_only_texts_beyond_ascii_reach_python(spark):
    texts = [None, "", "Plain ASCII\n", "ÉTÉ", "ΟΔΟΣ ΣΑΣ", "ﬁn½", "a\u0345\u05b0\u0301b", "İ", "\u0301", "㎏ x"] * 70
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string").repartition(1)
    made = rows.select("k", T.normalise("text").alias("n"))
    assert {r["k"]: r["n"] for r in made.collect()} == {k: T.normalise_text(t) for k, t in enumerate(texts)}
    assert "octet_length" in made._jdf.queryExecution().optimizedPlan().toString()
