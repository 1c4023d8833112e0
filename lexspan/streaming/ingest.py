"""Continuous ingest: texts that arrive are chunked and, batch by batch, appended to a folder or committed to the index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import diff
from ..operators.chunking import ChunkSize, chunk_documents, searchable
from ..plans.rebuild import STATES
from ..sources.durable import durable
from ..sources.store import Store, build_manifest


def ingest_stream(docs: DataFrame, path: str, checkpoint: str, size: ChunkSize = ChunkSize(), available_now: bool = True) -> StreamingQuery:
    """Appends searchable chunks of a stream of (file, text) to Parquet.

    Chunking keeps no state, so the file sink's log makes each batch count once. Ranks for
    ties (doc_ord) are given when a snapshot is published.
    """
    writer = searchable(chunk_documents(docs, size)).writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def commit_batch(batch: DataFrame, batch_id: int, store: Store, name: str, size: ChunkSize = ChunkSize()) -> bool:
    """Commits a batch of (file, text) to the final snapshot; False if the snapshot has it already.

    The manifest says which batch of the stream `name` it has last, and is swapped in with the
    batch's shards in one step, so a batch that is run again after a failure counts once. A file that
    comes again replaces what it was, in its last text in a batch (the greatest, of several); a null file is left out,
    a null text is a file without chunks. Only shards that hold such a file are written anew.
    """
    base = store.manifest("final")
    streams = (base or {}).get("streams", {})
    if streams.get(name, -1) >= batch_id:
        return False
    texts = durable(batch.where(F.col("file").isNotNull()).groupBy("file").agg(F.max("text").alias("text")))
    chunks = searchable(chunk_documents(texts, size))
    counted = chunk_documents(texts, size).groupBy("file").agg(F.count(F.lit(1)).alias("chunks"))
    fresh = texts.join(counted, "file", "left").select(
        "file", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"),
        F.lit("indexed").alias("status"), F.lit(None).cast("string").alias("reason"), F.coalesce("chunks", F.lit(0)).cast("long").alias("chunks"),
    )
    states = store.states(base) if base else store.spark.createDataFrame([], STATES)
    again = states.join(texts.select("file"), "file", "left_semi")
    shards, rest = (base["shards"], None) if base else ([], None)
    if not again.isEmpty():
        shards, rest = store.holding(base, again)
    if rest is not None:
        chunks = diff.union_index(rest.select(*chunks.columns), chunks)
    merged = durable(diff.merge_states(states, fresh, store.spark.createDataFrame([], "file string")))
    total = merged.agg(F.sum("chunks")).first()[0] or 0
    report = (base or {}).get("report", {}) | {"totalChunks": total}
    store.publish(chunks, merged, build_manifest(report, total, True, (base or {}).get("buildCommit")) | {"streams": streams | {name: batch_id}}, "final", shards)
    return True


def ingest_into(docs: DataFrame, store: Store, checkpoint: str, name: str, size: ChunkSize = ChunkSize(), available_now: bool = True) -> StreamingQuery:
    """Commits a stream of (file, text) to the store, where searches see each batch once its snapshot is loaded.

    `name` tells streams into one store apart and belongs to `checkpoint`. Stopped and started
    again, the index is that of one run. A store has one writer at a time.
    """
    writer = docs.writeStream.foreachBatch(lambda batch, batch_id: commit_batch(batch, batch_id, store, name, size)).option("checkpointLocation", checkpoint).queryName(name)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
