"""The service's calls: argument checks, bounds and response envelopes, without a transport."""

from __future__ import annotations

import hmac

from pyspark.sql import DataFrame

from ..functions.text import SPACES, clamp_int, requested_file
from ..operators.document import DEFAULT_LIMIT, LEAST_LIMIT, MOST_LIMIT, read_document
from ..operators.scoring import unique_queries
from ..operators.search import DEFAULT_K, LEAST_K, MOST_K, search
from ..operators.signatures import possible
from ..sources.files import MEMORY_MB
from ..sources.store import Store, now
from .rebuild import CHECKPOINT_EVERY, Rebuild

MOST_ALTERNATES = 7
#: Shards from which on a search looks at signatures first.
PRUNE_FROM = 32


def valid_alternates(value: object) -> list[str]:
    """Strings of a list, trimmed, empty ones left out, the first seven."""
    kept = [v.strip(SPACES) for v in value if isinstance(v, str)] if isinstance(value, list) else []
    return [v for v in kept if v][:MOST_ALTERNATES]


def _camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(w.capitalize() for w in rest)


class Service:
    """Status, search, document and rebuild over a store; each call returns (status code, body)."""

    def __init__(self, store: Store, rebuild: Rebuild, admin_token: str | None = None):
        self.store, self.rebuild_plan, self.admin_token = store, rebuild, admin_token
        self.manifest: dict | None = None
        self.mode = "none"
        self.loaded_at: str | None = None
        self._chunks: DataFrame | None = None
        self._signed: DataFrame | None = None

    def load(self) -> bool:
        """Opens the final snapshot, or a checkpoint while there is none; whether it has chunks.

        A missing shard is an error, and what was open stays open.
        """
        manifest, mode = self.store.manifest("final"), "final"
        if manifest is None:
            manifest, mode = self.store.checkpoint(self.rebuild_plan.commit), "checkpoint"
        if manifest and manifest["snapshot"] != (self.manifest or {}).get("snapshot"):
            self._chunks, self._signed = self.store.chunks(manifest), self.store.signatures(manifest)
            self.loaded_at = now()
        self.manifest, self.mode = manifest, mode if manifest else "none"
        return self.indexed_chunks > 0

    @property
    def indexed_chunks(self) -> int:
        return (self.manifest or {}).get("totalChunks", 0)

    def _index(self) -> dict:
        """What every answer says of the index."""
        return {"indexMode": self.mode, "indexedChunks": self.indexed_chunks, "rebuildInProgress": self.rebuild_plan._running.locked()}

    def chunks(self) -> DataFrame:
        """The open snapshot, held with its listing of files until another one is loaded."""
        return self._chunks

    def scored_chunks(self, queries: list[str]) -> DataFrame:
        """The chunks that a search scores: of PRUNE_FROM shards or more, only those of shards whose signatures have the terms. Hits are the same."""
        if len(self.manifest["shards"]) < PRUNE_FROM:
            return self._chunks
        return self.store.only(self._chunks, [r["name"] for r in possible(self._signed, queries).collect()])  # at most a name a shard

    def status(self) -> dict:
        """Counters and mode of the snapshot that is searched."""
        plan = self.rebuild_plan
        size = plan.size
        return {
            "ready": self.indexed_chunks > 0, "indexLoaded": self.indexed_chunks > 0, "finalIndexedChunks": self.indexed_chunks if self.mode == "final" else 0,
            "checkpointEveryFiles": CHECKPOINT_EVERY, "buildCommit": plan.commit, "lastError": plan.last_error,
            "indexLoadedAt": self.loaded_at, "lastRebuildAt": plan.rebuilt_at, "lastPublishedAt": plan.published_at.get("final"),
            "lastCheckpointAt": plan.published_at.get("checkpoint"), "shardSizeMB": self.store.shard_mb,
            "workerMemoryMB": MEMORY_MB, "workerTimeoutMS": None if plan.timeout is None else int(plan.timeout * 1000), "lastReport": plan.last_report, "createdAt": (self.manifest or {}).get("createdAt"),
            "chunkSize": size.size, "chunkOverlap": size.overlap,
        } | self._index()

    def search(self, body: dict) -> tuple[int, dict]:
        query = body.get("query")
        query = query.strip(SPACES) if isinstance(query, str) else ""
        if not query:
            return 400, {"error": "query is required"}
        if not self.indexed_chunks:
            return 503, {"error": "no index is loaded"} | self.status()
        k = clamp_int(body.get("topK"), DEFAULT_K, LEAST_K, MOST_K)
        alternates = valid_alternates(body.get("alternateQueries"))
        asked = unique_queries([query, *alternates])
        found = search(self.scored_chunks(asked), asked, k).drop("doc_ord", "chunk_no").collect()  # at most fifty rows
        hits = [{_camel(c): v for c, v in r.asDict().items()} for r in found]
        return 200, {"query": query, "alternateQueries": alternates, "topK": k, "resultCount": len(hits)} | self._index() | {"results": hits}

    def document(self, body: dict) -> tuple[int, dict]:
        file = requested_file(body.get("file") if isinstance(body.get("file"), str) else "")
        if not file:
            return 400, {"error": "file is required"}
        if not self.indexed_chunks:
            return 503, {"error": "no index is loaded"}
        limit = clamp_int(body.get("limit"), DEFAULT_LIMIT, LEAST_LIMIT, MOST_LIMIT)
        page = read_document(self.store.chunks_of(self.manifest, self._chunks, file), file, clamp_int(body.get("offset"), 0, 0, 2**31 - 1), limit).first()
        return (404, {"error": "the file is not in the index", "file": file}) if page is None else (200, {_camel(c): v for c, v in page.asDict().items()} | self._index())

    def refusal(self, token: str | None) -> tuple[int, dict] | None:
        """Why a rebuild isn't allowed now, if it isn't."""
        if not self.admin_token:
            return 503, {"error": "rebuilding is not enabled"}
        if not hmac.compare_digest((token or "").encode(), f"Bearer {self.admin_token}".encode()):
            return 401, {"error": "unauthorised"}
        if self.rebuild_plan._running.locked():
            return 409, {"error": "a rebuild is in progress"}
        return None

    def rebuild(self, token: str | None, files: DataFrame) -> tuple[int, dict]:
        refused = self.refusal(token)
        if refused:
            return refused
        report = self.rebuild_plan.run(files)
        self.load()
        return 202, report
