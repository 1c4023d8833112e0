"""Versioned snapshots of an index: commits of Parquet shards, manifests that list shards of several commits, and a pointer swapped last.

A commit writes its own new shards only and numbers them on from those that its snapshot
takes over, so a checkpoint costs what is new in it. All file access goes through Hadoop's
file system, so a store may lie wherever Spark reads.
"""

from __future__ import annotations

import json
import time
import uuid
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunking import searchable
from ..operators.shards import DEFAULT_MB, LEAST_MB, assign_shards, line_bytes, shard_name
from ..operators.signatures import signatures
from .ndjson import write_shards

VERSION = 6
CHUNK = "file string, folder string, chunk_no int, start int, content string, content_norm string, path_norm string"
SIGNATURE = "name string, page int, bits binary"
#: Seconds for which what no pointer reaches is kept.
GRACE = 3600


def collated(column: str = "file") -> F.Column:
    """Sorts files in ingest order."""
    return F.expr(f"{column} COLLATE UNICODE")


def listed_file() -> F.Column:
    """The shard that a row was read from, as manifests list it. Filters on it keep files from being opened."""
    return F.regexp_extract("_metadata.file_path", "(commits/[^/]+/chunks/.*)$", 1)


class Store:
    """A folder of snapshots. `final` and `checkpoint` each point to one of them.

    shard_mb bounds the chunks of a shard, counted as lines of JSON. The manifest has an
    entry a shard, so it should grow with the corpus: 1024 makes 100,000 of 100 TB. One
    writer at a time; readers need no lock.
    """

    def __init__(self, spark: SparkSession, root: str, shard_mb: int = DEFAULT_MB, grace: float = GRACE):
        self.spark, self.root, self.shard_mb, self.grace = spark, root.rstrip("/"), max(LEAST_MB, shard_mb), grace
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _read(self, name: str) -> str | None:
        path = self._path(f"{self.root}/{name}")
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return str(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write(self, name: str, text: str) -> None:
        """Writes beside the name and renames over it in one step, so that readers see the old text or the new."""
        beside, path = self._path(f"{self.root}/{name}.{uuid.uuid4().hex}"), self._path(f"{self.root}/{name}")
        self._fs.mkdirs(path.getParent())
        stream = self._fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        options = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        overwrite = self.spark.sparkContext._gateway.new_array(options, 1)
        overwrite[0] = options.OVERWRITE
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(context.makeQualified(beside), context.makeQualified(path), overwrite)

    def commit(self, chunks: DataFrame, after: int = 0) -> list[dict]:
        """Writes chunks as new shards, numbered on from `after`; their entries in the manifest.

        Chunks that don't have content_norm and path_norm yet get them behind the shuffles. Shards are those of next-fit over the lines of JSON in ingest order, a file each;
        bytes are those on disk, lineBytes those of the lines, first and last the
        least and greatest file, by which readers pick shards. Beside them lie the shards' signatures.
        """
        at = f"commits/{uuid.uuid4().hex}"
        columns = [f.split()[0] for f in CHUNK.split(", ")]
        ordered = chunks.select(*[c for c in columns if c in chunks.columns]).withColumn("__ord", collated())
        sharded = assign_shards(ordered, int(self.shard_mb * 1024 * 1024), "__ord").withColumn("shard_no", F.col("shard_no") + after)
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = sharded.repartition(n, "shard_no")
        dealt = dealt if "content_norm" in dealt.columns else searchable(dealt)
        sorted_ = dealt.sortWithinPartitions("shard_no", "__ord", "file", "chunk_no").select(*columns, "shard_no")
        sorted_.write.partitionBy("shard_no").parquet(f"{self.root}/{at}/chunks")
        written = self.spark.read.schema(f"{CHUNK}, shard_no int").parquet(f"{self.root}/{at}/chunks").select("*", listed_file().alias("name"), "_metadata.file_size")
        signed = signatures(written).repartitionByRange(n, "page").sortWithinPartitions("page", "name")
        signed.write.parquet(f"{self.root}/{at}/signatures")
        shards = written.groupBy("shard_no", "name", "file_size").agg(
            F.count(F.lit(1)).alias("chunks"), F.sum(line_bytes()).alias("lines"), F.min("file").alias("first"), F.max("file").alias("last")
        )
        return [
            {
                "file": r["name"], "name": shard_name(r["shard_no"]), "number": r["shard_no"], "chunks": r["chunks"],
                "bytes": r["file_size"], "lineBytes": r["lines"], "first": r["first"], "last": r["last"],
            }
            for r in shards.orderBy("shard_no").collect()  # an entry a shard
        ]

    def publish(self, chunks: DataFrame | None, states: DataFrame, manifest: dict, kind: str = "final", kept: list[dict] | None = None) -> dict:
        """Commits new chunks behind the `kept` shards of earlier commits and then points to the snapshot of both.

        A final one drops the checkpoint and what no pointer reaches any more, but for the
        final snapshot before it, which readers may still hold open.
        """
        kept = kept or []
        new = self.commit(chunks, max((s["number"] for s in kept), default=0)) if chunks is not None else []
        at = f"snapshots/{kind}-{uuid.uuid4().hex}"
        states.write.parquet(f"{self.root}/{at}/sources")
        manifest = manifest | {"snapshot": at, "shardSizeMB": self.shard_mb, "shards": kept + new}
        self._write(f"{at}/manifest.json", json.dumps(manifest, indent=2, ensure_ascii=False))
        before = json.loads(self._read(f"{kind}.json") or "{}").get("snapshot")
        self._write(f"{kind}.json", json.dumps({"snapshot": at, "previous": before}))
        if kind == "final":
            self._fs.delete(self._path(f"{self.root}/checkpoint.json"), False)
            self.clean()
        return manifest

    def _listed(self, folder: str) -> list[tuple[str, float]]:
        """Names in a folder and when they were last changed."""
        path = self._path(f"{self.root}/{folder}")
        return [(f"{folder}/{s.getPath().getName()}", s.getModificationTime() / 1000) for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def clean(self) -> list[str]:
        """Removes snapshots that no pointer reaches, and commits of which no snapshot left lists a shard, once they are `grace` seconds old."""
        pointers = [json.loads(self._read(f"{kind}.json") or "{}") for kind in ("final", "checkpoint")]
        reached = {p[k] for p in pointers for k in ("snapshot", "previous") if p.get(k)}
        used = set()
        for snapshot in reached:
            for s in json.loads(self._read(f"{snapshot}/manifest.json") or '{"shards": []}')["shards"]:
                used.add("/".join(s["file"].split("/")[:2]))
        old = time.time() - self.grace
        gone = [name for folder, kept in (("snapshots", reached), ("commits", used)) for name, changed in self._listed(folder) if name not in kept and changed <= old]
        for name in gone:
            self._fs.delete(self._path(f"{self.root}/{name}"), True)
        return gone

    def holding(self, manifest: dict, files: DataFrame) -> tuple[list[dict], DataFrame | None]:
        """The shards without chunks of `files`, and the chunks of the others that aren't of them (None: there is no such shard)."""
        paths = self.chunks(manifest).select("file", listed_file().alias("name")).join(files.select("file").distinct(), "file", "left_semi")
        hit = {r["name"] for r in paths.select("name").distinct().collect()}  # at most a name a shard
        touched = [s for s in manifest["shards"] if s["file"] in hit]
        rest = self.chunks(manifest | {"shards": touched}).join(files.select("file").distinct(), "file", "left_anti") if touched else None
        return [s for s in manifest["shards"] if s["file"] not in hit], rest

    def export(self, manifest: dict, folder: str) -> None:
        """The whole index as shards of lines of JSON, numbered by next-fit over all chunks in ingest order."""
        write_shards(assign_shards(self.chunks(manifest), int(self.shard_mb * 1024 * 1024)), folder)

    def manifest(self, kind: str = "final") -> dict | None:
        """The manifest that a pointer leads to; None without one. A damaged one is an error."""
        pointer = self._read(f"{kind}.json")
        if pointer is None:
            return None
        found = self._read(json.loads(pointer)["snapshot"] + "/manifest.json")
        return validate(json.loads(found or "null"))

    def checkpoint(self, commit: str | None) -> dict | None:
        """The checkpoint, unless it is of another build: both commits known and different."""
        found = self.manifest("checkpoint")
        return None if found and commit and found.get("buildCommit") and found["buildCommit"] != commit else found

    def chunks(self, manifest: dict) -> DataFrame:
        """The chunks of exactly the shards listed, with doc_ord to sort them; a missing one is an error at once."""
        paths = [f"{self.root}/{s['file']}" for s in manifest["shards"]]
        if not paths:
            return self.spark.createDataFrame([], CHUNK).withColumn("doc_ord", collated())
        try:
            return self.spark.read.schema(CHUNK).parquet(*paths).withColumn("doc_ord", collated())
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                raise ValueError(f"a shard is missing: {error.getMessageParameters().get('path', self.root)}") from error
            raise

    @staticmethod
    def only(chunks: DataFrame, names: list[str]) -> DataFrame:
        """Chunks of an open snapshot from the shards of these names; no other is opened, and nothing is listed again."""
        return chunks.where(listed_file().isin(names)) if names else chunks.where("false")

    def chunks_of(self, manifest: dict, chunks: DataFrame, file: str) -> DataFrame:
        """The chunks of the shards that may hold a file, known by the least and greatest file of each."""
        return self.only(chunks, [s["file"] for s in manifest["shards"] if s["first"] <= file <= s["last"]])

    def signatures(self, manifest: dict) -> DataFrame:
        """name (of a shard's file), page, bits of all commits that the snapshot has shards of."""
        commits = sorted({"/".join(s["file"].split("/")[:2]) for s in manifest["shards"]})
        if not commits:
            return self.spark.createDataFrame([], SIGNATURE)
        return self.spark.read.schema(SIGNATURE).parquet(*[f"{self.root}/{c}/signatures" for c in commits])

    def states(self, manifest: dict) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{manifest['snapshot']}/sources")


def now() -> str:
    """The time as manifests and the status give it: UTC, to the millisecond."""
    return datetime.now(UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z")


def validate(manifest: object) -> dict:
    """The manifest, if its shards are a list of objects with a file name."""
    shards = manifest.get("shards") if isinstance(manifest, dict) else None
    if not isinstance(shards, list) or not all(isinstance(s, dict) and isinstance(s.get("file"), str) for s in shards):
        raise ValueError("the manifest has no valid list of shards")
    return manifest


def build_manifest(report: dict, total_chunks: int, final: bool, commit: str | None = None, repository: str = "", branch: str = "main") -> dict:
    """A manifest, to which `publish` adds the shards; the states of sources lie beside it as a table, as they grow with the corpus."""
    return {
        "version": VERSION, "type": "final" if final else "checkpoint", "complete": final, "buildCommit": commit,
        "createdAt": now(),
        "repository": repository, "branch": branch, "totalChunks": total_chunks, "report": report,
    }
