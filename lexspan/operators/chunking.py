"""Documents to overlapping chunks, and chunks to the searchable table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_text, folder_of, normalise
from ..sources.durable import durable


@dataclass(frozen=True)
class ChunkSize:
    """Window and overlap in characters: the window at least 200, the overlap from 0 to one less than it."""

    size: int = 1400
    overlap: int = 200

    def __post_init__(self) -> None:
        for value in (self.size, self.overlap):
            if not isinstance(value, int):
                raise TypeError("chunk sizes must be integers")
        object.__setattr__(self, "size", max(200, self.size))
        object.__setattr__(self, "overlap", min(max(0, self.overlap), self.size - 1))

    @property
    def step(self) -> int:
        return self.size - self.overlap


def windows(cleaned: Column, size: ChunkSize = ChunkSize()) -> Column:
    """Array of (chunk_no, start, content): trimmed windows of cleaned text and where they begin, empty ones left out.

    The text is cut once, into blocks of a step; a window is its block and the beginning of
    those behind it. So the work grows with the text's length, however long it is, and a
    task holds a text, its blocks and its windows.
    """
    more = -(-size.overlap // size.step)  # blocks that a window reaches into beyond its own

    def cut(blocks: Column) -> Column:
        def window(block: Column, i: Column) -> Column:
            if more == 1:
                whole = F.concat(block, F.coalesce(F.substring(F.get(blocks, i + 1), 1, size.overlap), F.lit("")))
            else:
                whole = F.substring(F.array_join(F.slice(blocks, i + 1, F.lit(more + 1)), ""), 1, size.size)
            start = i * F.lit(size.step) + F.when(F.substring(block, 1, 1) == " ", 1).otherwise(0)
            return F.struct(start.cast("int").alias("start"), F.trim(whole).alias("content"))

        return F.transform(blocks, window)

    blocks = F.regexp_extract_all(cleaned, F.lit(f"(?s).{{1,{size.step}}}"), F.lit(0))
    # The blocks are an argument of a lambda, so that they are made once and not for each window.
    kept = F.filter(F.flatten(F.transform(F.array(blocks), cut)), lambda w: w["content"] != "")
    return F.transform(kept, lambda w, i: F.struct(i.alias("chunk_no"), w["start"].alias("start"), w["content"].alias("content")))


def chunk_documents(docs: DataFrame, size: ChunkSize = ChunkSize(), file: str = "file", text: str = "text") -> DataFrame:
    """file, folder, chunk_no, start, content of every chunk. No shuffle; columns of `docs` but these are not read."""
    # The windows are made in the generator: of a column, Spark would make them a second time to leave out rows without any.
    cleaned = docs.select(F.col(file).alias("file"), clean_text(F.col(text)).alias("__clean"))
    return (
        cleaned.select("file", folder_of(F.col("file")).alias("folder"), F.explode(windows(F.col("__clean"), size)).alias("c"))
        .select("file", "folder", "c.chunk_no", "c.start", "c.content")
    )


def chunks_of(cut: DataFrame) -> DataFrame:
    """The same of documents that are cut already and kept (file, windows)."""
    return cut.select("file", folder_of(F.col("file")).alias("folder"), F.explode("windows").alias("c")).select("file", "folder", "c.chunk_no", "c.start", "c.content")


def searchable(chunks: DataFrame) -> DataFrame:
    """Adds content_norm and path_norm, once, at ingest, so that no search computes them."""
    return chunks.withColumns({
        "content_norm": normalise(F.col("content")),
        "path_norm": normalise(F.concat_ws(" ", F.coalesce("file", F.lit("")), F.coalesce("folder", F.lit("")))),
    })


def in_ingest_order(chunks: DataFrame) -> DataFrame:
    """Adds doc_ord, the rank of the chunk's file by collated path: the tie-break of searches.

    Files are ranked by a fixed number of range partitions and their counts, so no single
    task sorts them all; the ranges are a checkpoint while the ranks are made from them.
    """
    files = chunks.select("file").distinct()
    ranged = files.withColumn("__key", F.expr("file COLLATE UNICODE"))
    ranges = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = durable(ranged.repartitionByRange(ranges, "__key", "file").sortWithinPartitions("__key", "file").withColumn("__id", F.monotonically_increasing_id()).drop("__key"))
    parts = sorted_.withColumn("__part", F.shiftright("__id", 33).cast("int")).withColumn("__at", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
    # One row a range.
    before = parts.groupBy("__part").count().withColumn("__before", F.sum("count").over(Window.orderBy("__part")) - F.col("count")).select("__part", "__before")
    ranks = parts.join(before, "__part").select("file", (F.col("__before") + F.col("__at")).alias("doc_ord"))
    return chunks.join(ranks, "file")


def chunk_stats(chunks: DataFrame, by: str = "folder") -> DataFrame:
    """Chunks, characters and UTF-8 bytes by a column."""
    return chunks.groupBy(by).agg(
        F.count(F.lit(1)).alias("chunks"), F.sum(F.length("content")).alias("characters"), F.sum(F.octet_length("content")).alias("bytes")
    )
