"""Configuration: TOML with ``${VAR}`` from the environment, as frozen dataclasses."""

from __future__ import annotations

import os
import re
import tomllib
from dataclasses import dataclass, field, fields
from typing import Any

from kvflow.operators.filters import FilterConfig

READERS = ("sync_reader", "scan_reader", "rdb_reader", "aof_reader")


@dataclass(frozen=True)
class SyncReader:
    cluster: bool = False
    address: str = ""
    username: str = ""
    password: str = ""
    tls: bool = False
    sync_rdb: bool = True
    sync_aof: bool = True
    prefer_replica: bool = False
    try_diskless: bool = False


@dataclass(frozen=True)
class ScanReader:
    cluster: bool = False
    address: str = ""
    username: str = ""
    password: str = ""
    tls: bool = False
    scan: bool = True
    ksn: bool = False
    dbs: tuple[int, ...] = ()
    prefer_replica: bool = False
    count: int = 1


@dataclass(frozen=True)
class RdbReader:
    filepath: str = ""


@dataclass(frozen=True)
class AofReader:
    filepath: str = ""
    timestamp: int = 0


@dataclass(frozen=True)
class Writer:
    cluster: bool = False
    sentinel: bool = False
    master: str = ""
    address: str = ""
    username: str = ""
    password: str = ""
    tls: bool = False
    off_reply: bool = False


@dataclass(frozen=True)
class Advanced:
    dir: str = "data"
    ncpu: int = 0
    pprof_port: int = 0
    status_port: int = 0
    log_file: str = "kvflow.log"
    log_level: str = "info"
    log_interval: int = 5
    rdb_restore_command_behavior: str = "panic"
    pipeline_count_limit: int = 1024
    target_client_max_querybuf_len: int = 1_024_000_000
    target_proto_max_bulk_len: int = 512_000_000
    aws_psync: str = ""
    empty_db_before_sync: bool = False


@dataclass(frozen=True)
class Module:
    target_mbbloom_version: int = 0


@dataclass(frozen=True)
class Config:
    """reader: the first section of READERS that is there.  function: Python source that defines ``function(call)``."""

    reader: SyncReader | ScanReader | RdbReader | AofReader
    writer: Writer | None = None
    filter: FilterConfig = field(default_factory=FilterConfig)
    function: str = ""
    advanced: Advanced = field(default_factory=Advanced)
    module: Module = field(default_factory=Module)


_KINDS = dict(zip(READERS, (SyncReader, ScanReader, RdbReader, AofReader), strict=True))
#: Older names of settings.
_ALIASES = {"target_redis_client_max_querybuf_len": "target_client_max_querybuf_len", "target_redis_proto_max_bulk_len": "target_proto_max_bulk_len"}
_WRITERS = ("writer", "redis_writer")


def _build(kind: type, section: dict[str, Any], where: str) -> Any:
    known = {f.name for f in fields(kind)}
    section = {_ALIASES.get(k, k): v for k, v in section.items()}
    if unknown := set(section) - known:
        raise ValueError(f"unknown settings in [{where}]: {', '.join(sorted(unknown))}")
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in section.items()})


def parse(text: str, env: dict[str, str] | None = None) -> Config:
    env = dict(os.environ) if env is None else env
    raw = tomllib.loads(re.sub(r"\$\{(\w+)\}", lambda m: env.get(m[1], ""), text))
    name = next((r for r in READERS if r in raw), None)
    if name is None:
        raise ValueError(f"one of {', '.join(READERS)} is needed")
    rules = dict(raw.get("filter", {}))
    function = rules.pop("function", "")
    writer = next((raw[w] for w in _WRITERS if w in raw), None)
    out = Config(
        reader=_build(_KINDS[name], raw[name], name),
        writer=None if writer is None else _build(Writer, writer, "writer"),
        filter=_build(FilterConfig, rules, "filter"),
        function=function,
        advanced=_build(Advanced, raw.get("advanced", {}), "advanced"),
        module=_build(Module, raw.get("module", {}), "module"),
    )
    if out.advanced.rdb_restore_command_behavior not in ("panic", "rewrite", "skip"):
        raise ValueError("rdb_restore_command_behavior is panic, rewrite or skip")
    return out


def load(path: str) -> Config:
    with open(path, encoding="utf-8") as f:
        return parse(f.read())


def psync_command(setting: str, address: str) -> str:
    """The name of PSYNC at an address; setting is ``address@name,...``, and addresses must be equal in full."""
    for part in filter(None, setting.split(",")):
        at, _, name = part.partition("@")
        if at == address:
            return name
    return "psync"
