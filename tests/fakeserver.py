"""A small key-value server for tests: enough of the protocol for the sources and sinks."""

import socket
import socketserver
import threading
import time

from kvflow.functions.resp import Incomplete, Reader, encode
from kvflow.sources import rdb, rdbvalues
from tests import encode as e


def bulk(b):
    return b"$-1\r\n" if b is None else b"$%d\r\n%s\r\n" % (len(b), b)


class FakeServer:
    """data: {db: {key: string value}}; ttl: {(db, key): ms}.  log: every command received with its database."""

    def __init__(self, data=None, ttl=None, password=None, listing=None, snapshot=b"", stream=b"", diskless=False, replication_info=""):
        self.data = {db: dict(d) for db, d in (data or {}).items()}
        self.ttl, self.password, self.listing = dict(ttl or {}), password, listing
        self.snapshot, self.stream, self.diskless, self.info = snapshot, stream, diskless, replication_info
        self.log, self.acks, self.listeners, self.lock = [], [], [], threading.Lock()
        outer = self

        class Handler(socketserver.BaseRequestHandler):
            def handle(self):
                outer.serve(self.request)

        class Server(socketserver.ThreadingTCPServer):
            allow_reuse_address = daemon_threads = True

        self.server = Server(("127.0.0.1", 0), Handler)
        self.address = "127.0.0.1:%d" % self.server.server_address[1]
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def close(self):
        self.server.shutdown()
        self.server.server_close()

    def serve(self, sock: socket.socket):
        reader = Reader(lambda n: sock.recv(65536))
        state = {"db": 0, "in": self.password is None, "quiet": False}
        try:
            while True:
                argv = reader.command()
                answer = self.answer(sock, state, argv)
                if answer is not None and not state["quiet"]:
                    sock.sendall(answer)
        except (Incomplete, ConnectionError, OSError):
            pass

    def notify(self, db, event, key):
        for sock in self.listeners:
            sock.sendall(encode(["pmessage", "__keyevent@*__:*", f"__keyevent@{db}__:{event}", key]))

    def answer(self, sock, state, argv):
        name, args = argv[0].upper(), argv[1:]
        db = state["db"]
        if name == b"AUTH":
            state["in"] = args[-1].decode() == self.password
            return b"+OK\r\n" if state["in"] else b"-WRONGPASS\r\n"
        if not state["in"]:
            return b"-NOAUTH Authentication required.\r\n"
        if name == b"PING":
            return b"+PONG\r\n"
        if name == b"SELECT":
            state["db"] = int(args[0])
            return b"+OK\r\n"
        if name == b"INFO":
            text = "".join(f"db{i}:keys={len(d)},expires=0\r\n" for i, d in self.data.items() if d) if args[0] == b"keyspace" else f"{self.info}\r\nmaster_repl_offset:{100 + len(self.stream)}\r\n"
            return bulk(text.encode())
        if name == b"SCAN":
            keys = sorted(self.data.get(db, {}))
            at, n = int(args[0]), int(args[2])
            more = at + n < len(keys)
            part = keys[at : at + n] + keys[:1]  # a key may come twice
            return b"*2\r\n" + bulk(b"%d" % (at + n if more else 0)) + b"*%d\r\n" % len(part) + b"".join(map(bulk, part))
        if name == b"DUMP":
            v = self.data.get(db, {}).get(args[0])
            return bulk(None if v is None else rdb.dump_value(rdbvalues.STRING, e.string(v)))
        if name == b"PTTL":
            return b":%d\r\n" % (-2 if args[0] not in self.data.get(db, {}) else self.ttl.get((db, args[0]), -1))
        if name == b"CLUSTER":
            return bulk(self.listing().encode())
        if name == b"SENTINEL":
            host, port = self.listing().split(":")
            return b"*2\r\n" + bulk(host.encode()) + bulk(port.encode())
        if name == b"CLIENT":
            state["quiet"] = args[1].upper() == b"OFF"
            return b"+OK\r\n"
        if name == b"PSUBSCRIBE":
            self.listeners.append(sock)
            return encode(["psubscribe", args[0]])
        if name == b"REPLCONF":
            if args[0].upper() == b"ACK":
                self.acks.append(int(args[1]))
                return None
            return b"+OK\r\n"
        if name in (b"PSYNC", b"XPSYNC"):
            if args[0] == b"?":
                mark = b"m" * 40
                body = b"$EOF:" + mark + b"\r\n" + self.snapshot + mark if self.diskless else b"$%d\r\n" % len(self.snapshot) + self.snapshot
                sock.sendall(b"\n\n+FULLRESYNC run1 100\r\n")
                sock.sendall(b"\n")
                for i in range(0, len(body), 7):
                    sock.sendall(body[i : i + 7])
                    time.sleep(0.0005)
                return None
            sock.sendall(b"+CONTINUE\r\n")
            sock.sendall(self.stream[int(args[1]) - 101 :])
            return None
        with self.lock:
            if name == b"RESTORE":
                if args[0] in self.data.get(db, {}) and not (len(args) > 3 and args[3].upper() == b"REPLACE"):
                    return b"-BUSYKEY Target key name already exists.\r\n"
                self.data.setdefault(db, {})[args[0]] = list(rdb.decode_dump(args[0], args[2]))[0][2]
            elif name == b"SET":
                self.data.setdefault(db, {})[args[0]] = args[1]
            elif name == b"FLUSHALL":
                self.data.clear()
            elif name == b"BOOM":
                return b"-ERR boom\r\n"
            self.log.append((db, argv))
        return b"+OK\r\n"
