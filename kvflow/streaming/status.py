"""Status of running streams: counters by command, rates, consistency; as a document and over HTTP."""

from __future__ import annotations

import json
import logging
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


log = logging.getLogger("kvflow")


def human_bytes(n: float, base: int = 1024) -> str:
    """A size in units of 1024 (KiB) or 1000 (kB)."""
    units = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"] if base == 1024 else ["B", "kB", "MB", "GB", "TB", "PB"]
    i = 0
    while n >= base and i < len(units) - 1:
        n, i = n / base, i + 1
    return f"{n:.1f} {units[i]}" if i else f"{n:.0f} B"


class Status:
    """Counts what batches read and wrote."""

    def __init__(self) -> None:
        self.lock = threading.Lock()
        self.start = time.strftime("%Y-%m-%d %H:%M:%S")
        self.read, self.written = Counter(), Counter()
        self.progress: dict = {}
        self.quiet = 0
        self.rates: tuple[float, int, int, float, float] = (time.monotonic(), 0, 0, 0.0, 0.0)

    def add(self, read: dict[str, int], written: dict[str, int]) -> None:
        with self.lock:
            self.read.update(read)
            self.written.update(written)

    def count(self, read: DataFrame, written: DataFrame) -> None:
        """Of a batch: two small aggregations."""
        by = lambda df: {r.cmd_name: r.n for r in df.groupBy("cmd_name").agg(F.count("*").alias("n")).collect()}
        self.add(by(read), by(written))

    def tick(self) -> None:
        """Rates since the last tick."""
        with self.lock:
            now, (then, r0, w0, *_) = time.monotonic(), self.rates
            r, w = sum(self.read.values()), sum(self.written.values())
            dt = max(1e-9, now - then)
            self.rates = (now, r, w, (r - r0) / dt, (w - w0) / dt)

    def on_progress(self, progress: dict) -> None:
        """consistent: two batches in a row found nothing new."""
        with self.lock:
            self.progress = progress
            self.quiet = self.quiet + 1 if not progress.get("numInputRows") else 0

    def line(self) -> str:
        """For the log."""
        d = self.document()
        total = d["total_entries_count"]
        return f"read {total['read_count']} ({total['read_ops']:.0f}/s), written {total['write_count']} ({total['write_ops']:.0f}/s), consistent {d['consistent']}"

    def log_every(self, seconds: float) -> threading.Event:
        """Log line() again and again until the event that is returned is set."""
        stop = threading.Event()

        def run() -> None:
            while not stop.wait(seconds):
                self.tick()
                log.info(self.line())

        threading.Thread(target=run, daemon=True).start()
        return stop

    def document(self) -> dict:
        with self.lock:
            _, _, _, read_rate, write_rate = self.rates
            entry = lambda r, w: {"read_count": r, "read_ops": read_rate, "write_count": w, "write_ops": write_rate}
            names = sorted(set(self.read) | set(self.written))
            return {
                "start_time": self.start,
                "consistent": self.quiet >= 2,
                "total_entries_count": entry(sum(self.read.values()), sum(self.written.values())),
                "per_cmd_entries_count": {n: {"read_count": self.read[n], "write_count": self.written[n]} for n in names},
                "reader": self.progress.get("sources", []),
                "writer": self.progress.get("sink", {}),
            }


class Listener(StreamingQueryListener):
    """Passes progress of all streams to a Status."""

    def __init__(self, status: Status) -> None:
        self.status = status

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.status.on_progress(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        self.status.on_progress({**self.status.progress, "numInputRows": 0})

    def onQueryTerminated(self, event) -> None:
        pass


def serve(status: Status, port: int = 0) -> ThreadingHTTPServer:
    """The status document at every path, on 127.0.0.1; port 0 picks one.  shutdown() ends it."""

    class Handler(BaseHTTPRequestHandler):
        timeout = 3

        def do_GET(self) -> None:
            status.tick()
            body = json.dumps(status.document(), default=str).encode()
            self.send_response(200)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args: object) -> None:
            pass

    server = ThreadingHTTPServer(("127.0.0.1", port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
