"""Replay of commands into the keyspace they leave behind: one row for each live key.

A key's state is what came after its last overwrite or removal (its boundary).  Boundaries are maxima, found with a
partial aggregation; what lies before them is dropped before values are gathered.  Fields and members keep their latest
write.  Times to live have a boundary of their own, which SET with KEEPTTL doesn't move.

SET and ZADD with NX or XX take effect by whether their key or member is there: that is what the last command before
them left that surely makes or removes it.  Only keys or members with such a command are put in order for it, in
stretches of the log, so that no task holds a key's history.  Removing fields or members one by one counts as leaving
the key there.  Commands that can't be replayed this way are left out and reported by unsupported().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Commands that write what replay understands.
OVERWRITE = ("SET", "SETNX", "SETEX", "PSETEX", "GETSET", "MSET")
REMOVE = ("DEL", "UNLINK", "GETDEL")
FLUSH = ("FLUSHDB", "FLUSHALL")
FIELD = ("HSET", "HMSET", "HDEL", "ZADD", "ZREM", "SADD", "SREM", "RPUSH", "LPUSH")
EXPIRY = ("EXPIRE", "PEXPIRE", "EXPIREAT", "PEXPIREAT", "PERSIST")
KNOWN = OVERWRITE + REMOVE + FLUSH + FIELD + EXPIRY
#: Options of ZADD before its scores; those that need a member's score aren't replayed.
ZADD_FLAGS, ZADD_SCORED = ("NX", "XX", "GT", "LT", "CH", "INCR"), ("GT", "LT", "INCR")
#: Options of SET that give a time to live, and the expiry command each stands for.
SET_TIMES = {"EX": "EXPIRE", "PX": "PEXPIRE", "EXAT": "EXPIREAT", "PXAT": "PEXPIREAT"}
#: Groups whose other commands change nothing here.
PASSIVE = ("SERVER", "CONNECTION", "CLUSTER", "PUBSUB", "SENTINEL", "TRANSACTIONS")
READS = (
    "GET MGET STRLEN GETRANGE SUBSTR LCS EXISTS TTL PTTL TYPE KEYS SCAN TOUCH DUMP OBJECT RANDOMKEY WAIT EXPIRETIME PEXPIRETIME HGET HMGET HGETALL HKEYS HVALS HLEN HEXISTS HSCAN HSTRLEN HRANDFIELD "
    "LLEN LRANGE LINDEX LPOS SCARD SMEMBERS SISMEMBER SMISMEMBER SSCAN SRANDMEMBER SINTER SUNION SDIFF SINTERCARD ZSCORE ZMSCORE ZCARD ZCOUNT ZRANK ZREVRANK ZRANGE ZREVRANGE ZRANGEBYSCORE ZREVRANGEBYSCORE "
    "ZRANGEBYLEX ZREVRANGEBYLEX ZLEXCOUNT ZSCAN ZRANDMEMBER ZUNION ZINTER ZDIFF ZINTERCARD XLEN XRANGE XREVRANGE XREAD XPENDING BITCOUNT BITPOS GETBIT PFCOUNT GEODIST GEOHASH GEOPOS GEOSEARCH"
).split()


def unsupported(entries: DataFrame) -> DataFrame:
    """cmd_name, n of the commands that may change keys and aren't replayed."""
    skip = (F.col("cmd_name").isin([*KNOWN, *READS]) & ~_left_out()) | F.col("group").isin(list(PASSIVE))
    return entries.where(~skip).groupBy("cmd_name").agg(F.count("*").alias("n"))


def _words(first: int) -> Column:
    """The arguments from place first on, as upper-case text."""
    return F.transform(F.slice("argv", first + 1, F.greatest(F.size("argv") - first, F.lit(0))), lambda a: F.upper(a.cast("string")))


def _zadd_flags() -> Column:
    """The options of ZADD that stand before the first score."""
    after = _words(2)
    plain = F.transform(after, lambda a: ~a.isin(list(ZADD_FLAGS)))
    return F.slice(after, 1, F.greatest(F.array_position(plain, F.lit(True)).cast("int") - 1, F.lit(0)))


def _left_out() -> Column:
    """Of known commands, those with options that aren't replayed."""
    scored = (F.col("cmd_name") == "ZADD") & F.arrays_overlap(_zadd_flags(), F.array(*map(F.lit, ZADD_SCORED)))
    conditional = F.col("cmd_name").isin([c for c in EXPIRY if c != "PERSIST"]) & (F.size("argv") > 3)
    return F.coalesce(scored | conditional, F.lit(False))


def _order(df: DataFrame) -> Column:
    """Where a command stands: seq, then ordinal where a function made several of one entry."""
    return F.struct("seq", F.col("ordinal") if "ordinal" in df.columns else F.lit(0).alias("ordinal"))


def effects(entries: DataFrame) -> DataFrame:
    """db_id, key, at, kind, field, value, i, only_if, how, n: what each replayed command does to each key.

    i follows the order of a command's arguments; only_if is NX or XX; how and n are the time to live that a string comes
    with.  A string of kind ``keep`` leaves the key's time to live as it is.
    """
    name, argv = F.col("cmd_name"), F.col("argv")
    none, no_text = F.lit(None).cast("binary"), F.lit(None).cast("string")
    row = "array<struct<key:binary,kind:string,field:binary,value:binary,i:int,only_if:string,how:string,n:binary>>"

    def one(kind: str | Column, field: Column = none, value: Column = none, key: Column | None = None, i: Column | None = None, only_if: Column = no_text, how: Column = no_text, n: Column = none) -> Column:
        key = F.get(argv, 1) if key is None else key
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.struct(
            key.alias("key"), kind.alias("kind"), field.alias("field"), value.alias("value"), (F.lit(0) if i is None else i).cast("int").alias("i"),
            only_if.alias("only_if"), how.alias("how"), n.alias("n"),
        )

    def steps(first: int, step: int) -> Column:
        last = F.size(argv) - step
        return F.when(last >= first, F.sequence(F.lit(first), F.greatest(last, F.lit(first)), F.lit(step))).otherwise(F.array().cast("array<int>"))

    singles = F.transform(steps(2, 1), lambda i: F.struct(i.alias("i"), F.get(argv, i).alias("x")))

    def members(kind: str) -> Column:
        return F.transform(singles, lambda s: one(kind, field=s["x"], i=s["i"]))

    def condition(words: Column) -> Column:
        return F.when(F.array_contains(words, "NX"), "NX").when(F.array_contains(words, "XX"), "XX")

    options = _words(3)
    timed = F.array_position(F.transform(options, lambda a: a.isin(list(SET_TIMES))), F.lit(True)).cast("int")
    how = None
    for option, command in SET_TIMES.items():
        at = F.get(options, timed - 1) == option
        how = F.when(at, command) if how is None else how.when(at, command)
    kept = F.when(F.array_contains(options, "KEEPTTL"), "keep").otherwise("string")
    plain_set = one(kept, value=F.get(argv, 2), only_if=condition(options), how=how, n=F.when(timed > 0, F.get(argv, timed + 3)))
    flags = _zadd_flags()

    def scored(i: Column) -> Column:
        return one("zset", field=F.get(argv, i + 1), value=F.get(argv, i), i=i, only_if=condition(flags))

    first = F.size(flags) + 2
    scores = F.when(F.size(argv) >= first + 2, F.sequence(first, F.greatest(F.size(argv) - 2, first), F.lit(2))).otherwise(F.array().cast("array<int>"))

    def pairs(kind: str) -> Column:
        return F.transform(steps(2, 2), lambda i: one(kind, field=F.get(argv, i), value=F.get(argv, i + 1), i=i))

    cases = [
        (("SET",), F.array(plain_set)),
        (("GETSET",), F.array(one("string", value=F.get(argv, 2)))),
        (("SETNX",), F.array(one("string", value=F.get(argv, 2), only_if=F.lit("NX")))),
        (("SETEX",), F.array(one("string", value=F.get(argv, 3), how=F.lit("EXPIRE"), n=F.get(argv, 2)))),
        (("PSETEX",), F.array(one("string", value=F.get(argv, 3), how=F.lit("PEXPIRE"), n=F.get(argv, 2)))),
        (("MSET",), F.transform(steps(1, 2), lambda i: one("string", value=F.get(argv, i + 1), key=F.get(argv, i), i=i))),
        (REMOVE, F.transform(steps(1, 1), lambda i: one("remove", key=F.get(argv, i), i=i))),
        (("HSET", "HMSET"), pairs("hash")),
        (("HDEL",), members("hash")),
        (("ZADD",), F.transform(scores, scored)),
        (("ZREM",), members("zset")),
        (("SADD",), F.transform(singles, lambda s: one("set", field=s["x"], value=F.lit(b"1"), i=s["i"]))),
        (("SREM",), members("set")),
        (("RPUSH",), F.transform(singles, lambda s: one("list", value=s["x"], i=s["i"]))),
        (("LPUSH",), F.transform(singles, lambda s: one("list", value=s["x"], i=-s["i"]))),
        (EXPIRY, F.array(one("expiry", field=name.cast("binary"), value=F.get(argv, 2)))),
    ]
    picked = None
    for names, value in cases:
        picked = F.when(name.isin(list(names)), value) if picked is None else picked.when(name.isin(list(names)), value)
    chosen = entries.where(name.isin([n for n in KNOWN if n not in FLUSH]) & ~_left_out())
    out = chosen.select("db_id", _order(entries).alias("at"), F.explode(picked.cast(row)).alias("e"))
    return out.select("db_id", "e.key", "at", "e.kind", "e.field", "e.value", "e.i", "e.only_if", "e.how", "e.n")


def _flushes(entries: DataFrame) -> DataFrame:
    """db_id (null: all), flushed_at: a row for each database that was flushed."""
    hit = entries.where(F.col("cmd_name").isin(list(FLUSH)))
    return hit.groupBy(F.when(F.col("cmd_name") == "FLUSHDB", F.col("db_id")).alias("db_id")).agg(F.max(_order(entries)).alias("flushed_at"))


#: Flushed databases that are broadcast; more are joined as they are.
BROADCAST_FLUSHED = 100_000


def _after_flushes(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Effects after the last flush of their database."""
    flushed = _flushes(entries)
    n = flushed.count()
    if not n:
        return rows
    each = flushed.where("db_id is not null")
    last = flushed.where("db_id is null").select("flushed_at").first()
    if last is not None:
        order = "struct<seq:bigint,ordinal:int>"
        rows = rows.where(F.col("at").cast(order) > F.struct(F.lit(last[0][0]).cast("long"), F.lit(last[0][1])).cast(order))
    met = rows.join(F.broadcast(each) if n <= BROADCAST_FLUSHED else each, "db_id", "left")
    return met.where(F.col("flushed_at").isNull() | (F.col("at") > F.col("flushed_at"))).drop("flushed_at")


def _settled(rows: DataFrame, by: list[str], event: Column, stretch: int) -> DataFrame:
    """rows without those whose only_if isn't met; those that take effect have no only_if any more.

    event: what a row leaves of what by names: true (it is there), false (it is gone), null (as it was).
    """
    if not rows.where("only_if is not null").limit(1).count():
        return rows
    named = rows.where("only_if is not null").select(*by).distinct()
    some = rows.join(named, by, "left_semi").withColumns({"event": event, "stretch": F.floor(F.col("at.seq") / stretch)})
    here = F.struct("at", "i")
    ends = some.groupBy(*by, "stretch").agg(F.max_by("event", F.when(F.col("event").isNotNull(), here)).alias("end"))
    before = Window.partitionBy(*by).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*by, "stretch", F.last("end", ignorenulls=True).over(before).alias("carried"))
    inside = Window.partitionBy(*by, "stretch").orderBy("at", "i").rowsBetween(Window.unboundedPreceding, -1)
    there = F.coalesce(F.last("event", ignorenulls=True).over(inside), "carried", F.lit(False))
    some = some.join(ends, [*by, "stretch"]).withColumn("there", there)
    some = some.where(F.col("only_if").isNull() | (F.col("there") == (F.col("only_if") == "XX")))
    return rows.join(named, by, "left_anti").unionByName(some.select(rows.columns)).withColumn("only_if", F.lit(None).cast("string"))


def _live(entries: DataFrame, stretch: int) -> DataFrame:
    """db_id, key, at, kind, field, value, i, over of effects at or after their key's boundaries; those of an overwrite's own
    command stay.  over: after the last overwrite, also where that kept the time to live."""
    rows = _after_flushes(effects(entries), entries)
    kind, only_if = F.col("kind"), F.col("only_if")
    written = F.col("value").isNotNull() & kind.isin("string", "keep", "hash", "zset", "set", "list")
    # A member's condition says nothing of its key, nor an unmet one of a string's.
    sets = F.when(kind == "remove", False).when(written & (only_if.isNull() | (only_if == "NX")), True)
    of_strings = rows.where(kind.isin("string", "keep") | only_if.isNull())
    of_members = rows.where((kind == "zset") & only_if.isNotNull())
    if of_members.limit(1).count():
        # For strings a member's ZADD NX makes its key and XX changes nothing: it takes part without its own condition.
        made = of_members.withColumn("kind", F.when(only_if == "NX", "made").otherwise("asked")).withColumn("only_if", F.lit(None).cast("string"))
        sets = F.when(kind == "made", True).when(kind == "asked", None).otherwise(sets)
        settled = _settled(of_strings.unionByName(made), ["db_id", "key"], sets, stretch).where(~kind.isin("made", "asked"))
        rows = settled.unionByName(of_members)
    else:
        rows = _settled(of_strings, ["db_id", "key"], sets, stretch)
    here = F.struct("at", "i")
    bound = rows.where(kind.isin("string", "keep", "remove")).groupBy("db_id", "key").agg(
        F.max(here).alias("bound"), F.max(F.when(kind != "keep", here)).alias("hard")
    )
    met = rows.join(bound, ["db_id", "key"], "left")

    def past(at: str) -> Column:
        return F.col(at).isNull() | (here > F.col(at)) | ((here == F.col(at)) & kind.isin("string", "keep"))

    met = met.where(past("hard")).withColumn("over", past("bound"))
    members = F.when((kind == "zset") & F.col("over"), F.when(F.col("value").isNull(), False).when(only_if.isNull() | (only_if == "NX"), True))
    met = _settled(met, ["db_id", "key", "field"], members, stretch)
    plain = ["db_id", "key", "at", "kind", "field", "value", "i", "over"]
    times = met.where("how is not null").select("db_id", "key", "at", F.lit("expiry").alias("kind"), F.col("how").cast("binary").alias("field"), F.col("n").alias("value"), (F.col("i") + 1).alias("i"), F.lit(True).alias("over"))
    return met.select(*plain).unionByName(times).withColumn("kind", F.when(F.col("kind") == "keep", "string").otherwise(F.col("kind")))


#: seq values whose conditional commands one task puts in order for a key.
STRETCH = 1 << 20


def keyspace(entries: DataFrame, now_ms: int | None = None, stretch: int = STRETCH) -> DataFrame:
    """db_id, key, type, string_val, list_val, set_val, hash_val, zset_val, expire_at_ms.

    A key has the type that was written first after its boundary; writes of another type would have been refused.  Keys
    left without a member are gone.  expire_at_ms needs now_ms for relative times; without it only absolute ones count.
    An expiry command before its key's first write does nothing.

    Two aggregations: by field (partial on the map side), then by key.
    """
    when = F.struct("at", "i")
    is_list, is_expiry = F.col("kind") == "list", F.col("kind") == "expiry"
    by_field = F.when(F.col("kind").isin("hash", "zset", "set"), F.col("field"))
    is_write = F.col("value").isNotNull() & ~is_expiry
    fields = _live(entries, stretch).where("kind <> 'remove'").withColumn("by", by_field).groupBy("db_id", "key", "kind", "by").agg(
        F.max_by(F.struct("field", "value"), F.when(is_expiry | F.col("over"), when)).alias("last"),
        F.min(F.when(is_write & F.col("over"), when)).alias("first"),
        F.min(F.when(is_write, when)).alias("made"),
        F.max(F.when(is_expiry, when)).alias("expired"),
        F.array_sort(F.collect_list(F.when(is_list & F.col("over"), F.struct(_list_place().alias("p"), "value")))).alias("items"),
    )
    value = F.col("last.value")

    def pairs(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when((F.col("kind") == kind) & value.isNotNull(), F.struct(F.col("by").alias("field"), value.alias("value")))))

    keys = fields.groupBy("db_id", "key").agg(
        F.min_by("kind", "first").alias("type"),
        F.max(F.when(F.col("kind") == "string", value)).alias("string"),
        F.flatten(F.collect_list(F.when(is_list, F.transform("items", lambda x: x["value"])))).alias("list"),
        *[pairs(k).alias(k) for k in ("set", "hash", "zset")],
        F.max(F.when(is_expiry, F.col("last"))).alias("expiry"),
        (F.max("expired") > F.min("made")).alias("counts"),
    )
    only = lambda kind, column: F.when(F.col("type") == kind, column)
    out = keys.select(
        "db_id",
        "key",
        "type",
        only("string", F.col("string")).alias("string_val"),
        only("list", F.col("list")).alias("list_val"),
        only("set", F.transform("set", lambda x: x["field"])).alias("set_val"),
        only("hash", F.map_from_entries("hash")).alias("hash_val"),
        only("zset", F.transform_values(F.map_from_entries("zset"), lambda k, v: v.cast("string").cast("double"))).alias("zset_val"),
        F.when(F.col("counts"), _expiry(now_ms)).alias("expire_at_ms"),
    )
    empty = (F.size(F.coalesce("set_val", F.array().cast("array<binary>"))) == 0) & F.col("type").isin("set")
    gone = empty | (only("hash", F.size("hash_val")) == 0) | (only("zset", F.size("zset_val")) == 0)
    return out.where(F.col("type").isNotNull() & ~F.coalesce(gone, F.lit(False)))


def _list_place() -> Column:
    """Right pushes in order after all left pushes, which stand in reverse order."""
    left = F.col("i") < 0
    seq, ordinal, i = F.col("at.seq"), F.col("at.ordinal"), F.col("i")
    return F.when(left, F.struct(F.lit(0).alias("side"), (-seq).alias("a"), (-ordinal).alias("b"), i.alias("c"))).otherwise(
        F.struct(F.lit(1).alias("side"), seq.alias("a"), ordinal.alias("b"), i.alias("c"))
    )


def _expiry(now_ms: int | None) -> Column:
    """Of the last expiry command after the key's boundary; none after PERSIST."""
    how, n = F.col("expiry.field").cast("string"), F.col("expiry.value").cast("string").cast("long")
    base = F.lit(now_ms).cast("long")
    return F.when(how == "PEXPIREAT", n).when(how == "EXPIREAT", n * 1000).when(how == "PEXPIRE", base + n).when(how == "EXPIRE", base + n * 1000)


def dbsize(space: DataFrame) -> DataFrame:
    return space.groupBy("db_id").agg(F.count("*").alias("keys"))


def restore_into(target: DataFrame, incoming: DataFrame, behaviour: str = "panic") -> DataFrame:
    """Keys restored over an existing keyspace: ``skip`` keeps what is there, ``rewrite`` replaces it, ``panic`` fails on a clash."""
    on = ["db_id", "key"]
    if behaviour == "skip":
        return target.unionByName(incoming.join(target.select(*on), on, "left_anti"), allowMissingColumns=True)
    if behaviour == "rewrite":
        return target.join(incoming.select(*on), on, "left_anti").unionByName(incoming, allowMissingColumns=True)
    if behaviour != "panic":
        raise ValueError("behaviour is panic, rewrite or skip")
    taken = target.select(*on).withColumn("taken", F.lit(True))
    clash = F.when(F.col("taken"), F.raise_error(F.concat(F.lit("key exists: "), F.col("key").cast("string"))).cast("boolean"))
    checked = incoming.join(taken, on, "left").where(clash.isNull()).drop("taken")
    return target.unionByName(checked, allowMissingColumns=True)
