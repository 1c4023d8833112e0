"""The checked queries over the retrieval operators, on a corpus view of `documents`, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import diff
from .operators.chunking import chunk_documents, chunk_stats, in_ingest_order, searchable
from .operators.document import reassemble, reassemble_exactly
from .operators.scoring import CompiledQuery, distinct_queries
from .operators.search import scored, search, search_many
from .operators.shards import assign_shards, shard_descriptors
from .operators.signatures import possible, signatures
from .sources.durable import durable
from .sources.files import ROOTS
from .sources.ndjson import parse_lines, to_lines

QUERIES = ["the that with", "state from src3 the", "que état des", "the"]
SINGLE = "état que national"
RARE = ["onwhtien oransh", "auxanoi laaiieroiai", "theaaner ingthan"]
#: Query sets that one scan answers.
SETS = {
    "all": QUERIES, "ties": ["for the"], "accents": ["État que national", "etat national"], "twice": ["the the"], "none": ["zzzz yyyy"], "laws": ["national act from src3", "the law of the state", "ción del"],
}
TERMS = ["the", "on", "aa", "état"]
SHARD = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, file, text: one document in each root in turn."""
    roots = F.array(*map(F.lit, ROOTS))
    root = F.element_at(roots, (F.col("doc_id") % len(ROOTS) + 1).cast("int"))
    file = F.concat(root, F.lit("/"), "source", F.lit("/"), "lang", F.lit("_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return table(spark, sf_dir, "documents").select("doc_id", file.alias("file"), "text")


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searchable chunks; the document's id is its place in the ingest order."""
    rows = chunk_documents(corpus(spark, sf_dir))
    return searchable(rows).withColumn("doc_ord", F.regexp_extract("file", r"_(\d+)\.txt$", 1).cast("long"))


def _key(df: DataFrame, *columns) -> DataFrame:
    return df.select("file", "chunk_no", *columns)


def clean_text(spark, d):
    return corpus(spark, d).select("doc_id", T.clean_text(F.col("text")).alias("cleaned"))


def normalise_text(spark, d):
    return corpus(spark, d).select("doc_id", T.normalise("text").alias("normalised"))


def query_terms(spark, d):
    terms = T.terms_of(T.normalise("text"))
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(terms, " ").alias("terms"), F.size(terms).alias("n_terms"))


def generic_terms(spark, d):
    terms = table(spark, d, "documents").select(F.explode(T.terms_of(T.normalise("text"))).alias("term"))
    return terms.groupBy("term").count().select("term", F.col("count").alias("occurrences"), T.is_generic(F.col("term")).alias("generic"))


def count_occurrences(spark, d):
    return corpus(spark, d).select("doc_id", *[T.count_occurrences(F.lower("text"), t).alias(f"n{k}") for k, t in enumerate(TERMS)])


def folder_of(spark, d):
    return corpus(spark, d).select("file", T.folder_of(F.col("file")).alias("folder"), T.requested_file_of(F.concat(F.lit("  "), F.replace("file", F.lit("/"), F.lit("\\")), F.lit(" "))).alias("requested"))


def chunked(spark, d):
    return chunk_documents(corpus(spark, d)).withColumn("start", F.col("start").cast("long"))


def stats(spark, d):
    return chunk_stats(chunk_documents(corpus(spark, d)))


def score_single(spark, d):
    rows = _key(chunks(spark, d), CompiledQuery(SINGLE).score.alias("score"))
    return rows.where("score > 0")


def score_multi(spark, d):
    return _key(scored(chunks(spark, d), QUERIES), "score")


def search_topk(spark, d):
    return search(chunks(spark, d), QUERIES).select("file", "chunk_no", "score")


def search_sets(spark, d):
    found = search_many(chunks(spark, d), SETS)
    return found.select("query_set", "file", "chunk_no", "score", F.array_join("matched_queries", "|").alias("matched"), F.array_join("matched_terms", "|").alias("terms"))


def search_pruned(spark, d):
    """A search of only those folders whose signatures may hold enough of its terms; SQL scores them all."""
    rows = chunks(spark, d)
    may = possible(durable(signatures(rows, "folder")), RARE).withColumnRenamed("name", "folder")
    return search(rows.join(may, "folder", "left_semi"), RARE).select("file", "chunk_no", "score")


def ingest_order(spark, d):
    return in_ingest_order(corpus(spark, d).select("file", "doc_id"))


def search_topk_ties(spark, d):
    return search(chunks(spark, d), ["for the"]).select("file", "chunk_no", "score")


def matched_queries(spark, d):
    return _key(scored(chunks(spark, d), QUERIES), F.array_join("matched_queries", "|").alias("matched"))


def matched_terms(spark, d):
    return _key(scored(chunks(spark, d), QUERIES), F.array_join("matched_terms", "|").alias("matched"))


def unique_spellings(spark, d):
    """The queries of each conversation: a turn's text, its role, and the same in capitals between spaces."""
    turns = table(spark, d, "conversations")
    spellings = F.posexplode(F.array("text", "role", F.concat(F.lit("  "), F.upper("role"), F.lit(" ")), F.lit(" ")))
    asked = turns.select("conv_id", "turn", spellings.alias("k", "query")).select("conv_id", (F.col("turn") * 4 + F.col("k")).alias("pos"), "query")
    return distinct_queries(asked, "conv_id", "pos", "query")


def distinct_path_bonus(spark, d):
    return _key(chunks(spark, d), CompiledQuery(QUERIES[1]).path_bonus.cast("long").alias("bonus"))


def phrase_bonus(spark, d):
    return _key(chunks(spark, d), CompiledQuery("the that").phrase_bonus.alias("bonus"), CompiledQuery("of the").phrase_bonus.alias("too_short"))


def sources(spark, d) -> tuple[DataFrame, DataFrame]:
    """Current sources, and a base: labelled documents, some modified or skipped, and pages, all of them gone."""
    now = corpus(spark, d).select("doc_id", "file", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"), F.octet_length("text").cast("long").alias("size"))
    labels = table(spark, d, "labels")
    known = now.join(labels, "doc_id").select(
        "file", F.when(F.col("quality") == 0, F.lit("0")).otherwise(F.col("sha256")).alias("sha256"), "size",
        F.when(F.col("toxic") == 1, "skipped").otherwise("indexed").alias("status"), F.lit(None).cast("string").alias("reason"), F.col("quality").cast("long").alias("chunks"),
    )
    pages = table(spark, d, "pages").select(
        F.concat(F.lit("05_COMPANIES/"), F.col("page_id").cast("string"), F.lit(".pdf")).alias("file"), F.sha2("html", 256).alias("sha256"),
        F.octet_length("html").cast("long").alias("size"), F.lit("indexed").alias("status"), F.lit(None).cast("string").alias("reason"), F.lit(1).cast("long").alias("chunks"),
    )
    return now.drop("doc_id"), known.unionByName(pages)


def _diff(f: Callable) -> Callable:
    return lambda spark, d: f(*sources(spark, d))


def copy_chunks(spark, d):
    return diff.copy_chunks(chunk_documents(corpus(spark, d)), diff.unchanged(*sources(spark, d))).select("file", "chunk_no", "content")


def union_index(spark, d):
    now, base = sources(spark, d)
    rows = chunk_documents(corpus(spark, d)).select("file", "chunk_no", "content")
    taken, new = diff.copy_chunks(rows, diff.unchanged(now, base)), diff.copy_chunks(rows, diff.changed(now, base))
    return diff.union_index(taken.withColumn("part", F.lit("copied")), new.withColumn("part", F.lit("new"))).select("file", "chunk_no", "part")


def merge_states(spark, d):
    now, base = sources(spark, d)
    fresh = now.join(diff.changed(now, base), "file").select("file", "sha256", "size", F.lit("indexed").alias("status"), F.lit(None).cast("string").alias("reason"), F.lit(7).cast("long").alias("chunks"))
    return diff.merge_states(base, fresh, diff.deleted(now, base)).drop("reason")


def source_hash(spark, d):
    return sources(spark, d)[0]


def document_page(spark, d):
    page = T.slice_page(T.clean_text(F.col("text")), 1000, 1500)
    return corpus(spark, d).select("file", *[c.cast("long").alias(n) if n not in ("text", "has_more") else c.alias(n) for n, c in page.items()])


def document_exact(spark, d):
    return reassemble_exactly(chunk_documents(corpus(spark, d)))


def document_reassembled(spark, d):
    return reassemble(chunk_documents(corpus(spark, d)))


def _sharded(spark, d) -> DataFrame:
    rows = chunks(spark, d).select("file", "folder", "content", "doc_ord", "chunk_no")
    return assign_shards(rows, SHARD)


def shard_assignment(spark, d):
    return _sharded(spark, d).select("file", "chunk_no", "shard_no")


def descriptors(spark, d):
    return shard_descriptors(_sharded(spark, d))


def ndjson_roundtrip(spark, d):
    return parse_lines(to_lines(chunk_documents(corpus(spark, d)))).select("file", "folder", "content")


def ndjson_guard(spark, d):
    """Page rows as JSON of all kinds: only objects with a string file and content stay."""
    pages = table(spark, d, "pages")
    kinds = F.array(
        F.to_json(F.struct(F.col("url").alias("file"), F.col("html").alias("content"))), F.to_json(F.struct(F.col("page_id").alias("file"), F.col("html").alias("content"))),
        F.to_json(F.struct(F.col("url").alias("file"))), F.lit("null"), F.lit("5"), F.lit("{bad"), F.lit("  "),
    )
    return parse_lines(pages.select("page_id", F.posexplode(kinds).alias("kind", "value"))).select("page_id", "kind", "file", "content")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "clean_text": clean_text, "normalise_text": normalise_text, "query_terms": query_terms, "generic_terms": generic_terms,
        "count_occurrences": count_occurrences, "folder_of": folder_of, "chunk_documents": chunked, "chunk_stats": stats,
        "score_single": score_single, "score_multi": score_multi, "search_topk": search_topk, "search_topk_ties": search_topk_ties, "search_many": search_sets, "ingest_order": ingest_order, "search_pruned": search_pruned,
        "matched_queries": matched_queries, "matched_terms": matched_terms, "unique_queries": unique_spellings,
        "distinct_path_bonus": distinct_path_bonus, "phrase_bonus": phrase_bonus,
        "sources_match": _diff(diff.sources_match), "completed": _diff(diff.completed), "changed": _diff(diff.changed),
        "unchanged": _diff(diff.unchanged), "deleted": _diff(diff.deleted), "copy_chunks": copy_chunks, "union_index": union_index,
        "merge_states": merge_states, "source_hash": source_hash, "document_page": document_page, "document_exact": document_exact,
        "document_reassembled": document_reassembled, "shard_assignment": shard_assignment, "shard_descriptors": descriptors,
        "ndjson_roundtrip": ndjson_roundtrip, "ndjson_guard": ndjson_guard,
    }


# --- SQL -------------------------------------------------------------------------------

_ROOTS = ", ".join(f"'{r}'" for r in ROOTS)
_DOCS = f"""docs AS (
  SELECT doc_id, [{_ROOTS}][(doc_id % 6)::INTEGER + 1] || '/' || source || '/' || lang || '_' || doc_id || '.txt' AS file,
    source AS folder, text, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS x
  FROM documents
)"""
_CHUNKS = f"""{_DOCS},
cut AS (SELECT doc_id, file, folder, x, unnest(range(0, length(x)::BIGINT, 1200)) AS low FROM docs),
chunks AS (
  SELECT doc_id, file, folder, (low // 1200)::INTEGER AS chunk_no, low + (substr(x, low + 1, 1) = ' ')::BIGINT AS start,
    trim(substr(x, low + 1, 1400)) AS content
  FROM cut WHERE trim(substr(x, low + 1, 1400)) <> ''
)"""
_NORM = f"""{_CHUNKS},
norm AS (SELECT *, strip_accents(lower(content)) AS cn, strip_accents(lower(file || ' ' || folder)) AS pn FROM chunks)"""


def _hits(term: str) -> str:
    return f"((length(cn) - length(replace(cn, '{term}', ''))) // {len(term)})"


def _score_sql(query: str) -> tuple[str, str, str]:
    """SQL of score (null: no match), of the matched terms as a list, and of the path bonus."""
    terms = T.query_terms(query)
    own = [t for t in terms if not T.is_generic_term(t)]
    if not terms:
        return "NULL::INTEGER", "[]::VARCHAR[]", "0"
    total = lambda parts: "(" + (" + ".join(parts) or "0") + ")"
    m = total([f"({_hits(t)} > 0)::INTEGER" for t in terms])
    path = total([f"22 * contains(pn, '{t}')::INTEGER" for t in own])
    hits = total([f"least({_hits(t)}, 4) * {8 if t in own else 3}" for t in terms])
    distinct = total([f"20 * ({_hits(t)} > 0)::INTEGER" for t in own])
    phrase = T.phrase_of(query)
    exact = f"35 * contains(cn, '{phrase}')::INTEGER" if len(phrase) > 6 else "0"
    score = f"CASE WHEN {m} >= 2 THEN ({hits} + 6 * {m} * {m} + {distinct} + {path} + {exact})::INTEGER END"
    return score, f"list_filter([{', '.join(f'''CASE WHEN {_hits(t)} > 0 THEN '{t}' END''' for t in dict.fromkeys(terms))}], lambda t: t IS NOT NULL)", path


def _multi(queries_: list[str]) -> str:
    parts = [_score_sql(q) for q in queries_]
    columns = ", ".join(f"{s} AS s{k}, {t} AS t{k}" for k, (s, t, _) in enumerate(parts))
    n = range(len(parts))
    best, count = ", ".join(f"coalesce(s{k}, 0)" for k in n), " + ".join(f"(s{k} IS NOT NULL)::INTEGER" for k in n)
    names = ", ".join(f"CASE WHEN s{k} IS NOT NULL THEN '{q}' END" for k, q in enumerate(queries_))
    terms = " || ".join(f"CASE WHEN s{k} IS NOT NULL THEN t{k} ELSE [] END" for k in n)
    return f"""{_NORM},
each AS (SELECT file, chunk_no, doc_id, {columns} FROM norm WHERE NOT starts_with(file, '00_GPT_CONFIGURATION/')),
hits AS (
  SELECT file, chunk_no, doc_id, (greatest({best}) + 8 * greatest({count} - 1, 0))::INTEGER AS score,
    array_to_string([{names}], '|') AS queries, {terms} AS terms
  FROM each WHERE greatest({best}) > 0
)"""


_SOURCES = f"""{_DOCS},
now AS (SELECT file, sha256(coalesce(text, '')) AS sha256, strlen(text)::BIGINT AS size, doc_id FROM docs),
base AS (
  SELECT file, CASE WHEN quality = 0 THEN '0' ELSE sha256 END AS sha256, size, CASE WHEN toxic = 1 THEN 'skipped' ELSE 'indexed' END AS status, quality::BIGINT AS chunks
  FROM now JOIN labels USING (doc_id)
  UNION ALL SELECT '05_COMPANIES/' || page_id || '.pdf', sha256(html), strlen(html)::BIGINT, 'indexed', 1 FROM pages
),
done AS (SELECT now.file, base.status FROM now JOIN base ON now.file = base.file AND now.sha256 = base.sha256)"""

_LINES = f"""{_CHUNKS},
lines AS (
  SELECT *, strlen(to_json({{'file': file, 'folder': folder, 'content': content}})::VARCHAR)::BIGINT + 1 AS bytes,
    row_number() OVER (ORDER BY doc_id, chunk_no) AS pos FROM chunks
),
packed AS (
  SELECT pos, bytes AS used, 1 AS shard_no FROM lines WHERE pos = 1
  UNION ALL
  SELECT l.pos, CASE WHEN p.used + l.bytes > {SHARD} THEN l.bytes ELSE p.used + l.bytes END, p.shard_no + (p.used + l.bytes > {SHARD})::INTEGER
  FROM packed p JOIN lines l ON l.pos = p.pos + 1
)"""


def oracle_sql() -> dict[str, str]:
    counts = ", ".join(f"((length(lower(text)) - length(replace(lower(text), '{t}', ''))) // {len(t)})::INTEGER AS n{k}" for k, t in enumerate(TERMS))
    words = lambda column: f"list_filter(regexp_split_to_array(strip_accents(lower({column})), '[^\\p{{L}}\\p{{N}}_-]+'), lambda t: length(t) > 2)"
    generic = ", ".join(f"'{w}'" for w in T.GENERIC_WORDS)
    return {
        "clean_text": f"WITH {_DOCS} SELECT doc_id, x AS cleaned FROM docs",
        "normalise_text": "SELECT doc_id, strip_accents(lower(text)) AS normalised FROM documents",
        "query_terms": f"SELECT conv_id, turn, array_to_string({words('text')}, ' ') AS terms, len({words('text')})::INTEGER AS n_terms FROM conversations",
        "generic_terms": f"SELECT term, count(*) AS occurrences, term IN ({generic}) AS generic FROM (SELECT unnest({words('text')}) AS term FROM documents) GROUP BY term",
        "count_occurrences": f"SELECT doc_id, {counts} FROM documents",
        "folder_of": f"WITH {_DOCS} SELECT file, folder, file AS requested FROM docs",
        "chunk_documents": f"WITH {_CHUNKS} SELECT file, folder, chunk_no, start, content FROM chunks",
        "chunk_stats": f"WITH {_CHUNKS} SELECT folder, count(*) AS chunks, sum(length(content))::BIGINT AS characters, sum(strlen(content))::BIGINT AS bytes FROM chunks GROUP BY folder",
        "score_single": f"WITH {_NORM} SELECT * FROM (SELECT file, chunk_no, {_score_sql(SINGLE)[0]} AS score FROM norm) WHERE score > 0",
        "score_multi": f"WITH {_multi(QUERIES)} SELECT file, chunk_no, score FROM hits",
        "search_topk": f"WITH {_multi(QUERIES)} SELECT file, chunk_no, score FROM hits ORDER BY score DESC, doc_id, chunk_no LIMIT 8",
        "search_pruned": f"WITH {_multi(RARE)} SELECT file, chunk_no, score FROM hits ORDER BY score DESC, doc_id, chunk_no LIMIT 8",
        "search_topk_ties": f"WITH {_multi(['for the'])} SELECT file, chunk_no, score FROM hits ORDER BY score DESC, doc_id, chunk_no LIMIT 8",
        "search_many": "\nUNION ALL ".join(
            f"""SELECT '{name}' AS query_set, * FROM (
  WITH {_multi(own)} SELECT file, chunk_no, score, queries AS matched, array_to_string(list_filter(terms, lambda t, i: list_position(terms, t) = i), '|') AS terms
  FROM hits ORDER BY score DESC, doc_id, chunk_no LIMIT 8)""" for name, own in SETS.items()
        ),
        # In these paths the collation puts _ before . before / before digits before letters, and case after all else.
        "ingest_order": f"WITH {_DOCS} SELECT doc_id, file, row_number() OVER (ORDER BY translate(lower(file), '_./', chr(1) || chr(2) || chr(3)), file) - 1 AS doc_ord FROM docs",
        "matched_queries": f"WITH {_multi(QUERIES)} SELECT file, chunk_no, queries AS matched FROM hits",
        "matched_terms": f"""WITH {_multi(QUERIES)} SELECT file, chunk_no, array_to_string(list_filter(terms, lambda t, i: list_position(terms, t) = i), '|') AS matched FROM hits""",
        "unique_queries": """
WITH asked AS (
  SELECT conv_id, turn * 4 + k - 1 AS pos, trim([text, role, '  ' || upper(role) || ' ', ' '][k]) AS q FROM conversations, (SELECT unnest([1, 2, 3, 4]) AS k)
),
firsts AS (
  SELECT conv_id, q, pos FROM asked WHERE q <> '' QUALIFY row_number() OVER (PARTITION BY conv_id, strip_accents(lower(q)) ORDER BY pos) = 1
)
SELECT conv_id, (row_number() OVER w - 1)::INTEGER AS query_no, q AS query FROM firsts WINDOW w AS (PARTITION BY conv_id ORDER BY pos) QUALIFY row_number() OVER w <= 8""",
        "distinct_path_bonus": f"WITH {_NORM} SELECT file, chunk_no, ({_score_sql(QUERIES[1])[2]})::BIGINT AS bonus FROM norm",
        "phrase_bonus": f"WITH {_NORM} SELECT file, chunk_no, (35 * contains(cn, 'the that')::INTEGER)::INTEGER AS bonus, 0 AS too_short FROM norm",
        "sources_match": f"""WITH {_SOURCES},
pairs AS (SELECT now.sha256 = base.sha256 AS same FROM now FULL JOIN base ON now.file = base.file)
SELECT count(*) FILTER (same IS NOT TRUE) = 0 AS matches, count(*) FILTER (same IS NOT TRUE) AS mismatches FROM pairs""",
        "completed": f"WITH {_SOURCES} SELECT file, status FROM done",
        "changed": f"WITH {_SOURCES} SELECT file FROM now WHERE file NOT IN (SELECT file FROM done)",
        "unchanged": f"WITH {_SOURCES} SELECT file FROM done WHERE status = 'indexed'",
        "deleted": f"WITH {_SOURCES} SELECT file FROM base WHERE file NOT IN (SELECT file FROM now)",
        "copy_chunks": f"WITH {_SOURCES}, {_CHUNKS.removeprefix(_DOCS + ',')} SELECT file, chunk_no, content FROM chunks WHERE file IN (SELECT file FROM done WHERE status = 'indexed')",
        "union_index": f"""WITH {_SOURCES}, {_CHUNKS.removeprefix(_DOCS + ',')}
SELECT file, chunk_no, 'copied' AS part FROM chunks WHERE file IN (SELECT file FROM done WHERE status = 'indexed')
UNION ALL SELECT file, chunk_no, 'new' FROM chunks WHERE file NOT IN (SELECT file FROM done)""",
        "merge_states": f"""WITH {_SOURCES}
SELECT file, sha256, size, 'indexed' AS status, 7::BIGINT AS chunks FROM now WHERE file NOT IN (SELECT file FROM done)
UNION ALL SELECT file, sha256, size, status, chunks FROM base WHERE file IN (SELECT file FROM done)""",
        "source_hash": f"WITH {_SOURCES} SELECT file, sha256, size FROM now",
        "document_page": f"""WITH {_DOCS}
SELECT file, least(1000, length(x))::BIGINT AS "offset", (least(2500, length(x)) - least(1000, length(x)))::BIGINT AS returned_characters, length(x)::BIGINT AS total_characters,
  length(x) > 2500 AS has_more, CASE WHEN length(x) > 2500 THEN 2500::BIGINT END AS next_offset, substr(x, 1001, 1500) AS text FROM docs""",
        "document_exact": f"WITH {_CHUNKS} SELECT c.file, count(*) AS chunk_count, any_value(d.x) AS text FROM chunks c JOIN docs d ON c.file = d.file GROUP BY c.file",
        "document_reassembled": f"""WITH RECURSIVE {_CHUNKS},
ranked AS (SELECT file, content, row_number() OVER (PARTITION BY file ORDER BY chunk_no) AS n, count(*) OVER (PARTITION BY file) AS chunk_count FROM chunks),
folded AS (
  SELECT file, n, chunk_count, content AS text FROM ranked WHERE n = 1
  UNION ALL
  SELECT f.file, r.n, f.chunk_count, CASE WHEN f.overlap IS NULL THEN f.text || ' ' || r.content ELSE f.text || substr(r.content, f.overlap + 1) END
  FROM (
    SELECT g.*, list_max(list_filter(range(20, least(1000, length(g.text), length(c.content)) + 1), lambda k: suffix(g.text, left(c.content, k)))) AS overlap
    FROM folded g JOIN ranked c ON c.file = g.file AND c.n = g.n + 1
  ) f JOIN ranked r ON r.file = f.file AND r.n = f.n + 1
)
SELECT file, chunk_count, text FROM folded WHERE n = chunk_count""",
        "shard_assignment": f"WITH RECURSIVE {_LINES} SELECT file, chunk_no, shard_no FROM lines JOIN packed USING (pos)",
        "shard_descriptors": f"WITH RECURSIVE {_LINES} SELECT printf('rag-index-%04d.ndjson', shard_no) AS file, count(*) AS chunks, sum(bytes)::BIGINT AS bytes FROM lines JOIN packed USING (pos) GROUP BY shard_no",
        "ndjson_roundtrip": f"WITH {_CHUNKS} SELECT file, folder, content FROM chunks",
        "ndjson_guard": "SELECT page_id, 0 AS kind, url AS file, html AS content FROM pages",
    }
