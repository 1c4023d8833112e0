"""Chunks as lines of JSON, in and out."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import SPACES


def _string(variant: Column, name: str) -> Column:
    """A member of a JSON object if it is a string; numbers and the like aren't turned into one."""
    member = F.try_variant_get(variant, f"$.{name}", "variant")
    return F.when(F.schema_of_variant(member) == "STRING", F.try_variant_get(variant, f"$.{name}", "string"))


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """The columns of `lines`, and file, folder, content of lines that are objects with a string file and content.

    Blank and unparsable lines, scalars, and objects without both are dropped. A line is
    trimmed and parsed once: it is the argument of a lambda, whose result is unnested.
    """
    parsed = F.transform(F.array(F.btrim(F.col(line), F.lit(SPACES))), lambda t: F.when(t != "", F.try_parse_json(t)))
    members = F.transform(parsed, lambda v: F.when(
        F.schema_of_variant(v).startswith("OBJECT"), F.struct(*[_string(v, c).alias(c) for c in ("file", "folder", "content")])
    ))
    kept = [c for c in lines.columns if c not in ("file", "folder", "content")]
    return lines.select(*kept, F.inline(F.filter(members, lambda m: m["file"].isNotNull() & m["content"].isNotNull())))


#: Paths are compared as URIs with one slash behind the scheme: Spark gives `file:///a` for `file:/a`.
SCHEME = r"^([A-Za-z0-9+.-]+:)/+"


def _present(spark: SparkSession, paths: list[str]) -> list[tuple[str, str, int]]:
    """(path, its URI, number from 1) of the files that are there, from one listing a folder."""
    path_type, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    uri = lambda p: re.sub(SCHEME, r"\1/", p.toUri().toString())
    wanted, folders = [], {}
    for number, path in enumerate(paths, 1):
        full = path_type(path)
        full = full.getFileSystem(conf).makeQualified(full)
        wanted.append((full.toString(), uri(full), number))
        folders.setdefault(full.getParent().toString(), full)
    there = set()
    for full in folders.values():
        fs, folder = full.getFileSystem(conf), full.getParent()
        if fs.exists(folder):
            there.update(uri(s.getPath()) for s in fs.listStatus(folder) if s.isFile())
    return [w for w in wanted if w[1] in there]


def read_ndjson(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, folder, content, shard_no, block, line_no of the given shards; a missing one is skipped, one listed twice is read twice.

    One scan, however many shards there are: a shard's number goes by the path that a line
    came from. (shard_no, block, line_no) is the order of the lines: block is where the split
    of the file begins that holds the line, line_no grows inside it. `numbered` makes it gapless.
    """
    known = _present(spark, paths)
    if not known:
        return spark.createDataFrame([], "file string, folder string, content string, shard_no int, block long, line_no long")
    lines = spark.read.text(sorted({p for p, _, _ in known})).select(
        "value", F.regexp_replace("_metadata.file_path", SCHEME, "$1/").alias("__path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line_no")
    )
    numbers = spark.createDataFrame([(u, n) for _, u, n in known], "__path string, shard_no int")  # a row a shard, from the caller
    return parse_lines(lines.join(F.broadcast(numbers), "__path")).select("file", "folder", "content", "shard_no", "block", "line_no")


def numbered(lines: DataFrame) -> DataFrame:
    """Lines of `read_ndjson` with line_no gapless from 0 in each shard, without their block.

    A second pass counts the lines of each split. Where none of a split's lines was dropped their numbers follow
    from its first one's, so they stay where they were read; only lines of the other splits
    are sorted. A row a split, of at most spark.sql.files.maxPartitionBytes of lines, is broadcast.
    """
    splits = lines.groupBy("shard_no", "block").agg(F.count(F.lit(1)).alias("__n"), F.min("line_no").alias("__first"), F.max("line_no").alias("__last"))
    before = F.sum("__n").over(Window.partitionBy("shard_no").orderBy("block")) - F.col("__n")
    whole = F.col("__last") - F.col("__first") + 1 == F.col("__n")
    known = splits.select("shard_no", "block", before.alias("__before"), "__first", whole.alias("__whole"))
    met = lambda which: lines.join(F.broadcast(known.where(which)), ["shard_no", "block"])
    inside = F.row_number().over(Window.partitionBy("shard_no", "block").orderBy("line_no")) - 1
    out = lambda rows, place: rows.select("file", "folder", "content", "shard_no", (F.col("__before") + place).alias("line_no"))
    return out(met("__whole"), F.col("line_no") - F.col("__first")).unionByName(out(met("NOT __whole").withColumn("__in", inside), F.col("__in")))


def to_lines(chunks: DataFrame) -> DataFrame:
    """One JSON object a row, in `value`."""
    return chunks.select(F.to_json(F.struct("file", "folder", "content")).alias("value"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Writes chunks with shard_no as text, a folder a shard, in ingest order."""
    lines = sharded.select("shard_no", "doc_ord", "chunk_no", F.to_json(F.struct("file", "folder", "content")).alias("value"))
    lines.repartition("shard_no").sortWithinPartitions("shard_no", "doc_ord", "chunk_no").select("shard_no", "value").write.partitionBy("shard_no").text(path)
