"""The checked queries over sources, shards of lines and the published index, and their SQL.

Each publishes into a folder of its own below the shared one and reads back what a search would see.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators.shards import assign_shards
from .plans.rebuild import Rebuild
from .queries import _CHUNKS, _DOCS, _LINES, SHARD, chunks, corpus, table
from .sources.durable import shared_folder
from .sources.files import extract, is_source, relative_path
from .sources.ndjson import numbered, read_ndjson, write_shards
from .sources.store import Store

#: Bytes below which the reader of these queries refuses a file.
SHORTEST = 200
ROOT = "/srv/space law"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- sources ---------------------------------------------------------------------------


def source_paths(spark, d):
    """Files of each document as a listing gives them, below their root again; and whether they are sources."""
    file = F.col("file")
    kinds = F.array(F.replace(file, F.lit(".txt"), F.lit(".PDF")), F.replace(file, F.lit(".txt"), F.lit(" é+%.docx")), file, F.concat(F.lit("02_LAW/build/"), file, F.lit(".pdf")))
    named = corpus(spark, d).select("doc_id", F.posexplode(kinds).alias("kind", "named"))
    path = F.concat(F.lit("file://"), T.url_path_of(F.concat(F.lit(ROOT + "/"), F.col("named"))))
    return named.select("doc_id", "kind", relative_path(path, ROOT).alias("file")).withColumn("source", is_source(F.col("file")))


def raw_urls(spark, d):
    """Turns as paths of a URL, read back, and decoded as they stand."""
    url = T.url_path_of(F.col("text"))
    return table(spark, d, "conversations").select("conv_id", "turn", url.alias("url"), T.percent_decoded(url).alias("path"), T.percent_decoded(F.concat(F.lit("100%: "), "text")).alias("kept"))


def _docx(texts: pd.Series) -> pd.Series:
    """Each text as a DOCX, a paragraph a line."""
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"

    def made(text: str | None) -> bytes:
        lines = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(line)}</w:t></w:r></w:p>' for line in (text or "").split("\n"))
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{lines}</w:body></w:document>')
        return out.getvalue()

    return texts.map(made)


def docx_text(spark, d):
    """Each document as a DOCX and as a file that has no reader, extracted."""
    made = F.pandas_udf(_docx, "binary")
    files = corpus(spark, d).select(F.explode(F.array(F.replace("file", F.lit(".txt"), F.lit(".DocX")), "file")).alias("file"), made("text").alias("content"))
    return extract(files)


# --- shards of lines -------------------------------------------------------------------


def sharded_lines(spark, d):
    """Next-fit shards written as lines of JSON and read back in one scan, each line with its number in its shard."""
    folder = _folder(spark, "lines")
    write_shards(assign_shards(chunks(spark, d).select("file", "folder", "content", "doc_ord", "chunk_no"), SHARD), folder)
    listed = spark.read.format("binaryFile").load(folder).select("shard_no", "path").orderBy("shard_no")  # without their contents, which aren't read
    paths = [r["path"] for r in listed.collect()]  # a path a shard
    return numbered(read_ndjson(spark, paths)).select("shard_no", "line_no", "file", "content")


# --- the index -------------------------------------------------------------------------


def read_text(content: bytes) -> str:
    """A reader of plain text that refuses files shorter than SHORTEST."""
    if len(content) < SHORTEST:
        raise ValueError("too short")
    return content.decode()


def versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """An earlier state of the files and the present one.

    The earlier has labelled documents, those of low quality in another version, and pages, which are gone later.
    """
    as_file = lambda rows: rows.select("file", F.concat(F.lit("/"), "file").alias("absolute_path"), F.octet_length("content").cast("long").alias("size"), "content")
    content = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    now = corpus(spark, d)
    labelled = now.join(table(spark, d, "labels"), "doc_id").select("file", F.when(F.col("quality") == 0, F.concat(F.lit("earlier ").cast("binary"), content)).otherwise(content).alias("content"))
    pages = table(spark, d, "pages").select(F.concat(F.lit("05_COMPANIES/"), F.col("page_id").cast("string"), F.lit(".txt")).alias("file"), F.encode("html", "utf-8").alias("content"))
    return as_file(labelled.unionByName(pages)), as_file(now.select("file", content.alias("content")))


class _Lost(Store):
    """A store to which no final snapshot can be published."""

    def publish(self, chunks, states, manifest, kind="final", kept=None):
        if kind == "final":
            raise ConnectionError("lost")
        return super().publish(chunks, states, manifest, kind, kept)


def rebuilt(spark: SparkSession, d: str, lost: bool = False) -> tuple[Store, dict]:
    """A store after the rebuild of the earlier files and one of the present ones, and the last report.

    The second publishes a checkpoint on half of its files. If it is `lost`, it ends before its
    final snapshot, and a third resumes its checkpoint.
    """
    earlier, present = versions(spark, d)
    store, plan = Store(spark, _folder(spark, "index")), {"readers": {"txt": read_text}, "commit": "c1", "timeout": None}
    Rebuild(store, **plan).run(earlier, None)
    half = max(1, -(-present.count() // 2))
    if lost:
        try:
            Rebuild(_Lost(spark, store.root), **plan).run(present, half)
        except ConnectionError:
            pass
        return store, Rebuild(store, **plan).run(present, None)
    return store, Rebuild(store, **plan).run(present, half)


def rebuilt_index(spark, d):
    """What searches see after two rebuilds: chunks of the final snapshot, taken over and new ones."""
    store, _ = rebuilt(spark, d)
    return store.chunks(store.manifest()).select("file", "folder", "chunk_no", "content", "content_norm")


def rebuilt_states(spark, d):
    """The states of all sources after a rebuild that was lost behind its checkpoint and resumed."""
    store, _ = rebuilt(spark, d, lost=True)
    return store.states(store.manifest()).select("file", "sha256", "size", "status", "reason", "chunks")


def rebuild_report(spark, d):
    """The report's counts after two rebuilds, and those of the manifest's shards."""
    store, report = rebuilt(spark, d)
    names = ["discoveredFiles", "unchangedFiles", "changedFiles", "processedChangedFiles", "remainingChangedFiles", "indexedFiles", "skippedFiles", "copiedChunks", "newChunks", "totalChunks"]
    shards, gone = store.manifest()["shards"], report["deletedFiles"]
    row = {n: report[n] for n in names} | {"deletedFiles": gone, "shardChunks": sum(s["chunks"] for s in shards), "shardLines": sum(s["lineBytes"] for s in shards)}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} long" for n in row))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "source_paths": source_paths, "raw_urls": raw_urls, "docx_text": docx_text, "sharded_lines": sharded_lines,
        "rebuilt_index": rebuilt_index, "rebuilt_states": rebuilt_states, "rebuild_report": rebuild_report,
    }


# --- SQL -------------------------------------------------------------------------------

_REBUILT = f"""{_CHUNKS},
present AS (SELECT doc_id, file, sha256(coalesce(text, '')) AS sha256, strlen(coalesce(text, ''))::BIGINT AS size FROM docs),
states AS (
  SELECT file, sha256, size, CASE WHEN size < {SHORTEST} THEN 'skipped' ELSE 'indexed' END AS status, CASE WHEN size < {SHORTEST} THEN 'too short' END AS reason,
    CASE WHEN size < {SHORTEST} THEN 0 ELSE (SELECT count(*) FROM chunks c WHERE c.file = p.file) END::BIGINT AS chunks,
    EXISTS (FROM labels l WHERE l.doc_id = p.doc_id AND l.quality IS DISTINCT FROM 0) AS same
  FROM present p
),
seen AS (SELECT c.* FROM chunks c JOIN states s ON s.file = c.file WHERE s.status = 'indexed')"""


def oracle_sql() -> dict[str, str]:
    part = "url_encode(p)"
    for given, wanted in {"%21": "!", "%27": "''", "%28": "(", "%29": ")", "%2A": "*"}.items():
        part = f"replace({part}, '{given}', '{wanted}')"
    return {
        "source_paths": f"""WITH {_DOCS},
kinds AS (
  SELECT doc_id, unnest([0, 1, 2, 3])::INTEGER AS kind,
    unnest([replace(file, '.txt', '.PDF'), replace(file, '.txt', ' é+%.docx'), file, '02_LAW/build/' || file || '.pdf']) AS file FROM docs
)
SELECT doc_id, kind, file, kind < 2 AS source FROM kinds""",
        "raw_urls": f"""SELECT conv_id, turn, array_to_string(list_transform(string_split(replace(text, '\\', '/'), '/'), lambda p: {part}), '/') AS url,
  replace(text, '\\', '/') AS path, '100%: ' || text AS kept FROM conversations""",
        "docx_text": f"""WITH {_DOCS}
SELECT replace(file, '.txt', '.DocX') AS file, true AS ok, replace(coalesce(text, ''), chr(10), chr(10) || chr(10)) AS text, NULL::VARCHAR AS reason FROM docs
UNION ALL SELECT file, false, NULL, 'Unsupported file type' FROM docs""",
        "sharded_lines": f"""WITH RECURSIVE {_LINES}
SELECT shard_no, row_number() OVER (PARTITION BY shard_no ORDER BY pos) - 1 AS line_no, file, content FROM lines JOIN packed USING (pos)""",
        "rebuilt_index": f"WITH {_REBUILT} SELECT file, folder, chunk_no, content, strip_accents(lower(content)) AS content_norm FROM seen",
        "rebuilt_states": f"WITH {_REBUILT} SELECT file, sha256, size, status, reason, chunks FROM states",
        # Files that were skipped before and haven't changed are done, but no chunks are taken over from them.
        "rebuild_report": f"""WITH {_REBUILT}
SELECT count(*) AS "discoveredFiles", count(*) FILTER (same AND status = 'indexed') AS "unchangedFiles", count(*) FILTER (NOT same) AS "changedFiles",
  count(*) FILTER (NOT same) AS "processedChangedFiles", 0::BIGINT AS "remainingChangedFiles", count(*) FILTER (NOT same AND status = 'indexed') AS "indexedFiles",
  count(*) FILTER (NOT same AND status = 'skipped') AS "skippedFiles", coalesce(sum(chunks) FILTER (same), 0)::BIGINT AS "copiedChunks",
  coalesce(sum(chunks) FILTER (NOT same), 0)::BIGINT AS "newChunks", sum(chunks)::BIGINT AS "totalChunks", (SELECT count(*) FROM pages) AS "deletedFiles",
  sum(chunks)::BIGINT AS "shardChunks",
  (SELECT sum(strlen(to_json({{'file': file, 'folder': folder, 'content': content}})::VARCHAR)::BIGINT + 1)::BIGINT FROM seen) AS "shardLines"
FROM states""",
    }
