"""What changed between the current sources and an index: equi-joins on the file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A source with one of these states is done until its bytes change.
DONE = ("indexed", "skipped")


def _paired(current: DataFrame, base: DataFrame, how: str) -> DataFrame:
    now = current.select("file", F.col("sha256").alias("now_sha"))
    then = base.select(F.col("file").alias("base_file"), F.col("sha256").alias("base_sha"), "status")
    return now.join(then, now["file"] == then["base_file"], how)


def sources_match(current: DataFrame, base: DataFrame) -> DataFrame:
    """One row: whether both have the same files with the same hashes, all done; and how many don't."""
    same = (F.col("now_sha") == F.col("base_sha")) & F.col("status").isin(*DONE)
    off = F.count_if(~F.coalesce(same, F.lit(False)))
    return _paired(current, base, "full_outer").agg(off.alias("mismatches")).select((F.col("mismatches") == 0).alias("matches"), "mismatches")


def completed(current: DataFrame, base: DataFrame) -> DataFrame:
    """file, status of what needs no work: the hash is the same and the state is done."""
    return _paired(current, base, "inner").where((F.col("now_sha") == F.col("base_sha")) & F.col("status").isin(*DONE)).select("file", "status")


def changed(current: DataFrame, base: DataFrame) -> DataFrame:
    """Files that are new or modified."""
    return current.select("file").join(completed(current, base).select("file"), "file", "left_anti")


def unchanged(current: DataFrame, base: DataFrame) -> DataFrame:
    """Files whose chunks can be taken over."""
    return completed(current, base).where("status = 'indexed'").select("file")


def deleted(current: DataFrame, base: DataFrame) -> DataFrame:
    """Files of the index that are no more."""
    return base.select("file").join(current.select("file"), "file", "left_anti")


def copy_chunks(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """Chunks of the wanted files. Spark broadcasts the files only if they measure small enough."""
    return chunks.join(files.select("file").distinct(), "file", "left_semi")


def union_index(taken: DataFrame, new: DataFrame) -> DataFrame:
    """Chunks taken over and new ones, duplicates kept."""
    return taken.unionByName(new, allowMissingColumns=True)


def merge_states(base: DataFrame, new: DataFrame, gone: DataFrame) -> DataFrame:
    """file, sha256, size, status, reason, chunks: the base's states, the new ones over them, less what is gone."""
    fields = ["sha256", "size", "status", "reason", "chunks"]
    b, n = base.select("file", F.struct(*fields).alias("b")), new.select("file", F.struct(*fields).alias("n"))
    merged = b.join(n, "file", "full_outer").select("file", F.coalesce("n", "b").alias("s")).select("file", "s.*")
    return merged.join(gone.select("file"), "file", "left_anti")
