"""The checked queries over the operators of this folder, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embedding_dedup, exact_dedup, language_id, merkle, mixing, packing, quality, sharding, simhash, substring_dedup, suffix_dedup, toxicity, whitening
from .common import LOWER, UPPER, width
from .numbering import BLOCKS, PRIME, STEP

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents")).drop("row_number")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    texts = language_id.references(docs.where(language_id.fold("doc_id", 4) != 2))
    judged = language_id.identify(docs, texts, keep=["doc_id"])
    return judged.select("doc_id", (language_id.fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    sample = toxicity.training_rows(docs, labels.where(language_id.fold("doc_id", 5) != 0))
    judged = toxicity.score_documents(docs, toxicity.train(*sample), keep=["doc_id"])
    return judged.select("doc_id", (language_id.fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "spans")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixing_plan(table(spark, sf_dir, "documents"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    return mixing.by_position(plan.select(*columns, F.round("position", 9).alias("position")), width(spark))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    error = whitening.identity_error(vectors, model) if model else None
    shares = F.array(*[F.lit(float(e)) for e in model.explained]) if model else F.array().cast("array<double>")
    rows = whitening.whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return rows.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("k")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


LEAF_VALUES = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0
    text = F.when(tampered, F.replace(docs["text"], F.lit("\n"))).otherwise(docs["text"])
    return merkle.merkle_manifest(docs, LEAF_VALUES, claimed=merkle.leaf(*[docs[c] for c in LEAF_VALUES[:-1]], text))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_packing": op2_packing,
        "op3_simhash": op3_simhash,
        "op4_embedding_dedup": op4_embedding_dedup,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_sharding": op6_sharding,
        "op7_language_id": op7_language_id,
        "op8_toxicity": op8_toxicity,
        "op9_mixing": op9_mixing,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_quality": op11_quality,
        "op12_whitening": op12_whitening,
        "op13_merkle": op13_merkle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_suffix_dedup": SUFFIX_DEDUP, "op4_embedding_dedup": EMBEDDING_DEDUP, "op5_substring_dedup": SUBSTRING_DEDUP,
        "op6_sharding": SHARDING, "op9_mixing": MIXING, "op10_exact_dedup": EXACT_DEDUP,
        "op13_merkle": _merkle_sql(),
    }


def _repeats_sql(rows: str, n: str, part: str, window: str, length: int) -> str:
    """CTEs up to `removed`, figures of a row's maximal removed runs, and `gaps`, what lies between the runs.

    `rows` gives doc_id and its units and `n` their number. Windows are cut from parts, as a
    position far behind in a long string is slow to reach: `part` is that with the windows at
    units low to low + 499, `window` the window at unit p of a part x.
    """
    return f"""
WITH units AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(doc_id, {2**63 - 1}) AS key, * FROM ({rows})
),
parts AS MATERIALIZED (
  SELECT r, key, low, least(low + 500, {n} - {length - 1}) AS high, {part} AS x
  FROM (SELECT *, unnest(range(0, greatest({n} - {length - 1}, 0), 500)) AS low FROM units)
),
windows AS MATERIALIZED (
  SELECT r, key, low + p AS p, md5_number({window}) AS m FROM (SELECT *, unnest(range(0, high - low)) AS p FROM parts)
),
repeated AS (
  SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before
  FROM windows JOIN (SELECT m, min(key) AS least FROM windows GROUP BY m) USING (m) WHERE least < key
),
islands AS (
  SELECT r, p, sum((before IS NULL OR p > before + {length})::INTEGER) OVER (PARTITION BY r ORDER BY p) AS island FROM repeated
),
spans AS (
  SELECT r, min(p) AS low, max(p) + {length} AS high FROM islands GROUP BY r, island
),
removed AS (
  SELECT r, count(*) AS n_spans, sum(high - low)::BIGINT AS n_removed FROM spans GROUP BY r
),
gaps AS (
  SELECT r, coalesce(lag(high) OVER o, 0) AS low, least AS high
  FROM (SELECT r, low AS least, high FROM spans UNION ALL SELECT r, {n}, {n} FROM units) WINDOW o AS (PARTITION BY r ORDER BY least, high)
)"""


# The bytes are held as hexadecimal digits, two a byte.
SUFFIX_DEDUP = f"""{_repeats_sql("SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents", "strlen(h) // 2", "substr(h, 2 * low + 1, 1098)", "substr(x, 2 * p + 1, 100)", 50)},
kept AS (
  SELECT r, string_agg(substr(h, 2 * low + 1, 2 * (high - low)), '' ORDER BY low, high) AS h FROM gaps JOIN units USING (r) GROUP BY r
)
SELECT doc_id, (strlen(units.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM units JOIN kept USING (r) LEFT JOIN removed USING (r)
"""

SUBSTRING_DEDUP = f"""{_repeats_sql("SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents", "len(w)", "w[low + 1 : low + 512]", "array_to_string(x[p + 1 : p + 13], ' ')", 13)},
kept AS (
  SELECT r, flatten(list(w[low + 1 : high] ORDER BY low, high)) AS w FROM gaps JOIN units USING (r) GROUP BY r
)
SELECT doc_id, len(units.w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(array_to_string(kept.w, ' ')) AS kept_sha256
FROM units JOIN kept USING (r) LEFT JOIN removed USING (r)
"""

# All pairs of a label; what a row reaches is followed link by link.
EMBEDDING_DEDUP = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
),
sound AS (
  SELECT * FROM vectors WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b
  ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r AND list_cosine_similarity(a.v, b.v) >= 0.98
),
reached AS (
  SELECT a AS r, b FROM links UNION SELECT reached.r, links.b FROM reached JOIN links ON reached.b = links.a
),
least AS (
  SELECT reached.r, min(vec_id) AS least FROM reached JOIN vectors ON vectors.r = b GROUP BY reached.r
),
degrees AS (
  SELECT a AS r, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, least) AS component_id, coalesce(vec_id = least(vec_id, least), FALSE) AS kept
FROM vectors LEFT JOIN degrees USING (r) LEFT JOIN least USING (r)
"""


EXACT_DEDUP = f"""
WITH hashed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)
"""

_BLOCK = f"(((coalesce(doc_id, 0) % {PRIME} + {PRIME}) % {PRIME}) * {STEP}) % {PRIME} % {BLOCKS}"


def _feistel_sql(x: str) -> str:
    """One permutation of x in SQL: the rounds folded over their keys."""
    y = f"(((a & mask) + k) % {PRIME})"
    f = f"({y} * {y} % {PRIME} * {STEP} % {PRIME})"
    keys = ", ".join(f"{k}::BIGINT" for k in sharding.round_keys(1))
    return f"list_reduce([{keys}], lambda a, k: ((a & mask) << half) | xor(a >> half, xor({f}, {f} >> 11) & mask), {x})"


# DuckDB has no crc32, so a table of 256 steps is folded over the bytes.
_CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c
    FROM (SELECT unnest(range(256)) AS b)
  )
)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(
      list_transform(range(1, 2 * coalesce(strlen({text}), 0) + 1, 2), lambda i: ('0x' || substr(hex(encode({text})), i, 2))::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"""


SHARDING = f"""
WITH RECURSIVE {_CRC_TABLE},
rows_ AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 16 AS size, {_crc32("text")} AS text_crc32
  FROM documents, crc_table
),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY {_BLOCK}, doc_id NULLS FIRST, text_crc32, size) - 1 AS before,
    count(*) OVER () AS n
  FROM rows_
),
sized AS (
  SELECT *, (length(ltrim(bin(greatest(n - 1, 1)), '0')) + 1) // 2 AS half, (1::BIGINT << ((length(ltrim(bin(greatest(n - 1, 1)), '0')) + 1) // 2)) - 1 AS mask
  FROM numbered
),
walk AS (
  SELECT doc_id, size, text_crc32, n, half, mask, {_feistel_sql("before")} AS x FROM sized
  UNION ALL
  SELECT doc_id, size, text_crc32, n, half, mask, {_feistel_sql("x")} FROM walk WHERE x >= n
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % 40)::INTEGER AS shard, (x // 40)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM walk WHERE x < n
"""

# Streams are as long as the source, so a second pass starts at source_size. Weights 5, 2, 1 by rank.
MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INTEGER + 1]::DOUBLE AS weight FROM sources
),
ranked AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS fill,
    row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM weighed
),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER below, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS level
  FROM ranked WINDOW below AS (ORDER BY fill, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
  SELECT source, source_size, weight, coalesce(least(cap, weight * first_value(CASE WHEN level <= fill THEN level END IGNORE NULLS) OVER (
    ORDER BY fill, rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), cap) AS target FROM levels
),
streams AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, round(t.target)::BIGINT AS quota, (t.weight - 8.0::DOUBLE / 3) / 10 AS slope,
    (sum(s.size) OVER (PARTITION BY s.source ORDER BY {_BLOCK}, s.doc_id NULLS FIRST, s.size ROWS UNBOUNDED PRECEDING) - s.size)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
passes AS (
  SELECT *, greatest(0, least(size, quota - before)) AS taken0, greatest(0, least(size, quota - source_size - before)) AS taken1 FROM streams
),
timed AS (
  SELECT *, CASE WHEN taken0 > 0 THEN least(greatest((before + taken0 / 2.0::DOUBLE) / target, 0), 1)
    WHEN taken1 > 0 THEN least(greatest((source_size + before + taken1 / 2.0::DOUBLE) / target, 0), 1) END AS u
  FROM passes
)
SELECT doc_id, size, source_size, target, (taken0 + taken1)::BIGINT AS taken,
  round(2 * u / ((1 + slope) + sqrt(greatest((1 + slope) * (1 + slope) - 4 * slope * u, 0))), 9) AS position
FROM timed
"""

#: Levels of runs of three in the SQL, enough for 3 ** 14 leaves of a source and sources.
SQL_LEVELS = 14


def _merkle_sql() -> str:
    """The trees level by level: t0 are the leaves, u0 the sources' roots; a tree of one node stays as it is."""
    value = lambda x: f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"
    values = " || ".join(value(c) for c in LEAF_VALUES[:-1])

    def levels(t: str) -> str:
        out = []
        for k in range(SQL_LEVELS):
            out.append(f"""{t}{k + 1} AS MATERIALIZED (
  SELECT g, p // 3 AS p, (max(n) + 2) // 3 AS n, CASE WHEN max(n) = 1 THEN any_value(x) ELSE sha256(string_agg(x, '' ORDER BY p)) END AS x FROM {t}{k} GROUP BY g, p // 3
)""")
        return ",\n".join(out)

    def walk(t: str, w: str, first: str) -> str:
        """What each document's proof is and where its claimed leaf leads, with the siblings of each level."""
        out = [f"{w}0 AS MATERIALIZED ({first})"]
        for k in range(SQL_LEVELS):
            run = lambda side: f"coalesce((SELECT string_agg(x, '' ORDER BY p) FROM {t}{k} s WHERE s.g = w.g AND s.p // 3 = w.p // 3 AND s.p {side} w.p), '')"
            out.append(f"""{w}{k + 1} AS MATERIALIZED (
  SELECT r, g, p // 3 AS p, (n + 2) // 3 AS n, proof || before || after AS proof, CASE WHEN n = 1 THEN x ELSE sha256(before || x || after) END AS x
  FROM (SELECT *, {run("<")} AS before, {run(">")} AS after FROM {w}{k} w)
)""")
        return ",\n".join(out)

    return f"""
WITH {_CRC_TABLE},
leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS g, sha256({values} || {value("text")}) AS x,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN sha256({values} || {value("replace(text, chr(10), '')")}) ELSE sha256({values} || {value("text")}) END AS claimed
  FROM documents, crc_table
),
t0 AS MATERIALIZED (
  SELECT r, doc_id, g, x, claimed, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, x, r) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM leaves
),
{levels("t")},
u0 AS MATERIALIZED (
  SELECT '' AS g, g AS source, row_number() OVER (ORDER BY encode(g)) - 1 AS p, count(*) OVER () AS n, x FROM t{SQL_LEVELS}
),
{levels("u")},
{walk("t", "w", "SELECT r, g, p, n, '' AS proof, claimed AS x FROM t0")},
{walk("u", "v", f"SELECT r, '' AS g, u0.p, u0.n, proof, w{SQL_LEVELS}.x FROM w{SQL_LEVELS} JOIN u0 ON u0.source = w{SQL_LEVELS}.g")}
SELECT t0.doc_id, t0.x AS leaf, u0.x AS subroot, u{SQL_LEVELS}.x AS root, sha256(v.proof) AS proof_sha256, v.x AS folded_root, v.x = u{SQL_LEVELS}.x AS verified
FROM v{SQL_LEVELS} v JOIN t0 USING (r) JOIN u0 ON u0.source = t0.g, u{SQL_LEVELS}
"""
