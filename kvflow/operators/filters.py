"""Entry filters: by key prefix or suffix, database, command and command group."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Protocol noise of a replication stream.
NOISE = ("SELECT", "PING", "REPLCONF", "OPINFO", "MULTI", "EXEC")
NOISE_CHANNEL = "__sentinel__:hello"


@dataclass(frozen=True)
class FilterConfig:
    """Empty allow lists allow everything.  A block beats an allow.  Commands and groups are upper-case names."""

    allow_key_prefix: tuple[str | bytes, ...] = field(default=())
    allow_key_suffix: tuple[str | bytes, ...] = field(default=())
    block_key_prefix: tuple[str | bytes, ...] = field(default=())
    block_key_suffix: tuple[str | bytes, ...] = field(default=())
    allow_db: tuple[int, ...] = field(default=())
    block_db: tuple[int, ...] = field(default=())
    allow_command: tuple[str, ...] = field(default=())
    block_command: tuple[str, ...] = field(default=())
    allow_command_group: tuple[str, ...] = field(default=())
    block_command_group: tuple[str, ...] = field(default=())


def _any_of(key: Column, prefixes: tuple[str | bytes, ...], suffixes: tuple[str | bytes, ...]) -> Column:
    raw = lambda x: F.lit(x if isinstance(x, bytes) else x.encode())
    tests = [F.startswith(key, raw(p)) for p in prefixes] + [F.endswith(key, raw(s)) for s in suffixes]
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def key_passes(key: Column, cfg: FilterConfig) -> Column:
    """Of one key: an allow prefix or suffix fits (or there are none) and no block one does."""
    allowed = _any_of(key, cfg.allow_key_prefix, cfg.allow_key_suffix) if cfg.allow_key_prefix or cfg.allow_key_suffix else F.lit(True)
    return allowed & ~_any_of(key, cfg.block_key_prefix, cfg.block_key_suffix)


def _has_key_rules(cfg: FilterConfig) -> bool:
    return bool(cfg.allow_key_prefix or cfg.allow_key_suffix or cfg.block_key_prefix or cfg.block_key_suffix)


def mixed_keys(cfg: FilterConfig) -> Column:
    """True for commands of which some keys pass and some don't; those are dropped whole."""
    passes = lambda k: key_passes(k, cfg)
    return F.exists("keys", passes) & ~F.forall("keys", passes) if _has_key_rules(cfg) else F.lit(False)


def predicate(cfg: FilterConfig) -> Column:
    """All rules as one condition; a command without keys passes the key rules."""
    tests: list[Column] = []
    if cfg.allow_db:
        tests.append(F.col("db_id").isin(list(cfg.allow_db)))
    if cfg.block_db:
        tests.append(~F.col("db_id").isin(list(cfg.block_db)))
    if cfg.allow_command:
        tests.append(F.col("cmd_name").isin(list(cfg.allow_command)))
    if cfg.block_command:
        tests.append(~F.col("cmd_name").isin(list(cfg.block_command)))
    if cfg.allow_command_group:
        tests.append(F.col("group").isin(list(cfg.allow_command_group)))
    if cfg.block_command_group:
        tests.append(~F.col("group").isin(list(cfg.block_command_group)))
    if _has_key_rules(cfg):
        tests.append(F.forall("keys", lambda k: key_passes(k, cfg)))
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)


def apply_filters(entries: DataFrame, cfg: FilterConfig, metric: str | None = None) -> DataFrame:
    """Rows that pass.  metric: name of an observation that counts rows in and rows dropped for mixed keys."""
    if metric:
        entries = entries.observe(metric, F.count(F.lit(1)).alias("rows_in"), F.count_if(mixed_keys(cfg)).alias("mixed_keys"))
    return entries.where(predicate(cfg))


def drop_noise(entries: DataFrame) -> DataFrame:
    """Without the commands that only serve replication itself."""
    name = F.upper(F.get("argv", 0).cast("string"))
    hello = (name == "PUBLISH") & (F.get("argv", 1).cast("string") == NOISE_CHANNEL)
    return entries.where(~(name.isin(list(NOISE)) | F.coalesce(hello, F.lit(False))))
