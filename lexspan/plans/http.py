"""The service over HTTP, by the standard library."""

from __future__ import annotations

import json
import logging
import signal
import threading
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import DataFrame

from .service import Service

#: Bytes of a request's body at most.
MOST_BODY = 2 * 1024 * 1024


def serve(service: Service, files: Callable[[], DataFrame], host: str = "0.0.0.0", port: int = 3000) -> ThreadingHTTPServer:
    """A server, not yet started; `files` lists the sources when a rebuild is asked for.

    GET / and /health give the status; POST /rag/search, /rag/document and /rag/rebuild the
    service's calls. A rebuild is checked at once and then runs in the background.
    """

    class Handler(BaseHTTPRequestHandler):
        def _answer(self, code: int, body: dict) -> None:
            data = json.dumps(body, ensure_ascii=False, default=str).encode()
            self.send_response(code)
            self.send_header("Content-Type", "application/json; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_: object) -> None:
            pass

        def do_GET(self) -> None:
            if self.path not in ("/", "/health"):
                return self._answer(404, {"error": "not found"})
            self._answer(200, {"service": "lexspan", "ok": True} | service.status())

        def do_POST(self) -> None:
            try:
                size = int(self.headers.get("Content-Length") or 0)
                if size > MOST_BODY:
                    return self._answer(413, {"error": "the body is too large"})
                body = json.loads(self.rfile.read(size) or b"{}")
                if not isinstance(body, dict):
                    raise ValueError
            except ValueError:
                return self._answer(400, {"error": "the body isn't a JSON object"})
            calls = {"/rag/search": service.search, "/rag/document": service.document}
            try:
                if self.path in calls:
                    self._answer(*calls[self.path](body))
                elif self.path == "/rag/rebuild":
                    self._rebuild()
                else:
                    self._answer(404, {"error": "not found"})
            except Exception as error:
                self._answer(500, {"error": str(error)})

        def _rebuild(self) -> None:
            refused = service.refusal(self.headers.get("Authorization"))
            if refused:
                return self._answer(*refused)
            threading.Thread(target=lambda: service.rebuild(self.headers.get("Authorization"), files()), daemon=True).start()
            self._answer(202, {"accepted": True})

    return ThreadingHTTPServer((host, port), Handler)


def start(service: Service, files: Callable[[], DataFrame], host: str = "0.0.0.0", port: int = 3000) -> tuple[ThreadingHTTPServer, threading.Thread]:
    """A server that answers at once, and the thread that loads the index and then rebuilds it behind.

    A failure of either is logged and stops neither the other nor the server.
    """
    server = serve(service, files, host, port)
    threading.Thread(target=server.serve_forever, daemon=True).start()

    def prepare() -> None:
        log = logging.getLogger(__name__)
        try:
            log.info("index loaded: %s", service.load())
        except Exception:
            log.exception("the index could not be loaded")
        try:
            log.info("rebuild: %s", service.rebuild_plan.run(files()))
            service.load()
        except Exception:
            log.exception("the rebuild failed")

    behind = threading.Thread(target=prepare, daemon=True)
    behind.start()
    return server, behind


def run(service: Service, files: Callable[[], DataFrame], host: str = "0.0.0.0", port: int = 3000, grace: float = 10) -> None:
    """Starts the service and serves until SIGTERM or SIGINT, then closes within `grace` seconds. Main thread only."""
    ended = threading.Event()
    for s in (signal.SIGTERM, signal.SIGINT):
        signal.signal(s, lambda *_: ended.set())
    server, _ = start(service, files, host, port)
    ended.wait()
    closing = threading.Thread(target=server.shutdown, daemon=True)
    closing.start()
    closing.join(grace)
    server.server_close()
