"""Scores as generated code: a query is compiled to Column expressions over normalised text."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import PHRASE_BEYOND, SPACES, contains_phrase, count_occurrences, is_generic_term, normalise, normalise_text, phrase_of, query_terms

# The weights of a score.
CAPPED_HITS, GENERIC_HIT, DISTINCTIVE_HIT = 4, 3, 8
COVERAGE, DISTINCTIVE_CONTENT, DISTINCTIVE_PATH, PHRASE = 6, 20, 22, 35
ANOTHER_QUERY, LEAST_TERMS, MOST_QUERIES = 8, 2, 8


def unique_queries(queries: str | list) -> list[str]:
    """Trimmed strings, empty ones left out, the first of each normalised spelling, at most eight."""
    out: dict[str, str] = {}
    for q in queries if isinstance(queries, (list, tuple)) else [queries]:
        if isinstance(q, str) and (trimmed := q.strip(SPACES)):
            out.setdefault(normalise_text(trimmed), trimmed)
    return list(out.values())[:MOST_QUERIES]


def distinct_queries(rows: DataFrame, group: str, order: str, query: str) -> DataFrame:
    """`group`, query_no (from 0) and query: `unique_queries` of each group's rows in `order`; null and blank queries are left out."""
    trimmed = rows.select(F.col(group).alias("g"), F.col(order).alias("o"), F.btrim(F.col(query), F.lit(SPACES)).alias("q")).where("q <> ''")
    firsts = trimmed.groupBy("g", normalise(F.col("q")).alias("spelling")).agg(F.min(F.struct("o", "q")).alias("first"))
    place = F.row_number().over(Window.partitionBy("g").orderBy("first.o", "first.q"))
    return firsts.withColumn("n", place).where(F.col("n") <= MOST_QUERIES).select(F.col("g").alias(group), (F.col("n") - 1).alias("query_no"), F.col("first.q").alias("query"))


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns, F.lit(0))


class CompiledQuery:
    """Expressions for one query: hits of each term, matched terms, score (null: no match).

    `hits` gives a term's count where it is known already; else the text is searched for it.
    """

    def __init__(self, query: str, content: str = "content_norm", path: str = "path_norm", hits: Callable[[str], Column] | None = None):
        self.query = query
        self.terms = Counter(query_terms(query))  # in order; a repeated term counts as often
        text, where = F.col(content), F.col(path)
        self.hits = {t: hits(t) if hits else count_occurrences(text, t) for t in self.terms}
        found = {t: F.when(h > 0, 1).otherwise(0) for t, h in self.hits.items()}
        own = [t for t in self.terms if not is_generic_term(t)]
        self.matched = _sum([found[t] * n for t, n in self.terms.items()])
        self.path_bonus = _sum([F.when(where.contains(t), DISTINCTIVE_PATH * self.terms[t]).otherwise(0) for t in own])
        self.phrase_bonus = F.when(contains_phrase(text, query), PHRASE).otherwise(0)
        weigh = lambda t: GENERIC_HIT if is_generic_term(t) else DISTINCTIVE_HIT
        weighed = _sum([F.least(h, F.lit(CAPPED_HITS)) * (weigh(t) * self.terms[t]) for t, h in self.hits.items()])
        distinct = _sum([found[t] * (DISTINCTIVE_CONTENT * self.terms[t]) for t in own])
        total = weighed + self.matched * self.matched * COVERAGE + distinct + self.path_bonus + self.phrase_bonus
        self.score = F.when(self.matched >= LEAST_TERMS, total).cast("int") if self.terms else F.lit(None).cast("int")
        self.matched_terms = F.filter(F.array(*[F.when(h > 0, F.lit(t)) for t, h in self.hits.items()]), lambda t: t.isNotNull()) if self.terms else F.array().cast("array<string>")


RESULT = "array<struct<score:int,matched_queries:array<string>,matched_terms:array<string>>>"


def scored_row(queries: list[str], content: str = "content_norm", path: str = "path_norm") -> Column:
    """An array of one struct: score (best of the queries, and 8 for each further one that matches; null: none), matched_queries, matched_terms.

    Each different term is counted once a chunk, and each query's score computed once: both
    are arguments of a lambda, which are evaluated before what uses them.
    """
    queries = [q for q in queries if query_terms(q)]
    if not queries:
        return F.array(F.struct(F.lit(None), F.array(), F.array())).cast(RESULT)
    terms = list(dict.fromkeys(t for q in queries for t in query_terms(q)))
    counts = F.array(*[count_occurrences(F.col(content), t) for t in terms])

    def scores(h: Column) -> Column:
        each = [CompiledQuery(q, content, path, lambda t: F.get(h, F.lit(terms.index(t)))) for q in queries]
        return F.struct(F.array(*[c.score for c in each]).alias("scores"), F.array(*[c.matched_terms for c in each]).alias("terms"))

    def result(s: Column) -> Column:
        each = [F.get(s["scores"], F.lit(k)) for k in range(len(queries))]
        best = F.array_max(s["scores"])
        matching = F.size(F.filter(s["scores"], lambda x: x.isNotNull()))
        matched = F.filter(F.array(*[F.when(x.isNotNull(), F.lit(q)) for x, q in zip(each, queries, strict=True)]), lambda q: q.isNotNull())
        own = F.filter(s["terms"], lambda _, k: F.get(s["scores"], k).isNotNull())
        return F.struct(
            F.when(best > 0, best + F.lit(ANOTHER_QUERY) * F.greatest(matching - 1, F.lit(0))).cast("int").alias("score"),
            matched.alias("matched_queries"), F.array_distinct(F.flatten(own)).alias("matched_terms"),
        )

    return F.transform(F.transform(F.array(counts), scores), result)


_SETS = "array<struct<name:string,queries:array<struct<query:string,phrase:string,terms:array<struct<at:int,n:int,own:boolean>>>>>>"
SETS_RESULT = "array<struct<query_set:string,score:int,matched_queries:array<string>,matched_terms:array<string>>>"


def scored_sets(sets: dict[str, str | list], content: str = "content_norm", path: str = "path_norm") -> Column:
    """An array of (query_set, score, matched_queries, matched_terms), one for each set of queries that matches, scored as `scored_row` does.

    The sets are data, not code: one literal lists all terms, which are counted once a chunk,
    and one the queries as places in it, so the plan is the same for one set or a thousand.
    """
    prepared = {name: [q for q in unique_queries(queries) if query_terms(q)] for name, queries in sets.items()}
    terms = list(dict.fromkeys(t for own in prepared.values() for q in own for t in query_terms(q)))
    at = {t: k for k, t in enumerate(terms)}
    described = [
        {"name": name, "queries": [
            {"query": q, "phrase": phrase_of(q) if len(phrase_of(q)) > PHRASE_BEYOND else None, "terms": [{"at": at[t], "n": n, "own": not is_generic_term(t)} for t, n in Counter(query_terms(q)).items()]}
            for q in own
        ]}
        for name, own in prepared.items() if own
    ]
    if not described:
        return F.array().cast(SETS_RESULT)
    all_terms = F.from_json(F.lit(json.dumps(terms)), "array<string>")
    all_sets = F.from_json(F.lit(json.dumps(described)), _SETS)
    text, where = F.col(content), F.col(path)
    # Evaluated once a chunk, as the argument of a lambda: each term's place, hits and whether the path has it.
    found = F.transform(all_terms, lambda t: F.struct(t.alias("term"), count_occurrences(text, t).alias("hits"), where.contains(t).alias("path")))

    def result(f: Column) -> Column:
        hits = lambda x: F.get(f, x["at"])["hits"]
        total = lambda xs, value: F.aggregate(xs, F.lit(0), lambda sum_, x: sum_ + value(x))

        def one(q: Column) -> Column:
            xs = q["terms"]
            matched = total(xs, lambda x: F.when(hits(x) > 0, x["n"]).otherwise(0))
            weighed = total(xs, lambda x: x["n"] * (
                F.least(hits(x), F.lit(CAPPED_HITS)) * F.when(x["own"], DISTINCTIVE_HIT).otherwise(GENERIC_HIT)
                + F.when(x["own"] & (hits(x) > 0), DISTINCTIVE_CONTENT).otherwise(0) + F.when(x["own"] & F.get(f, x["at"])["path"], DISTINCTIVE_PATH).otherwise(0)
            ))
            phrase = F.when(F.coalesce(text.contains(q["phrase"]), F.lit(False)), PHRASE).otherwise(0)
            # The number of matched terms is the argument of a lambda too.
            return F.get(F.transform(F.array(matched), lambda m: F.when(m >= LEAST_TERMS, F.struct(
                q["query"].alias("query"), (weighed + m * m * COVERAGE + phrase).cast("int").alias("score"),
                F.transform(F.filter(xs, lambda x: hits(x) > 0), lambda x: F.get(f, x["at"])["term"]).alias("terms"),
            ))), F.lit(0))

        def of_set(s: Column) -> Column:
            each = F.filter(F.transform(s["queries"], one), lambda r: r.isNotNull())
            return F.get(F.transform(F.array(each), lambda rs: F.struct(
                s["name"].alias("query_set"), (F.array_max(F.transform(rs, lambda r: r["score"])) + (F.size(rs) - 1) * ANOTHER_QUERY).cast("int").alias("score"),
                F.transform(rs, lambda r: r["query"]).alias("matched_queries"), F.array_distinct(F.flatten(F.transform(rs, lambda r: r["terms"]))).alias("matched_terms"),
            )), F.lit(0))

        return F.filter(F.transform(all_sets, of_set), lambda r: r["score"] > 0)

    return F.flatten(F.transform(F.array(found), result))
