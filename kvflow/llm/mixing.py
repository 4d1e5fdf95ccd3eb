"""Mixing sources to target weights over packed blocks.  DataFrame functions only.

Each source's words, in a fixed pseudorandom order of its documents, are packed into blocks of BLOCK words.  An output
shard of SHARD_SLOTS slots draws its source counts from the multinomial distribution of the target shares (each slot by
one lookup in an alias table, so at a cost that doesn't grow with the sources); draws beyond a source's quota go to the
sources short of theirs.  A source's uses are numbered through the shards; use u is pass
u div n over its n blocks, and index u mod n goes through a keyed permutation of the n indices.  Blocks are then joined
by (source, index).  A pass takes each block once, so no word is taken more than ceil(target / size) times, which is 2.

Targets: sources in code-point order, null last, weigh 3, 1, 2 in turn and share 150 % of all words.  A target stops at
twice its source's words; the excess is shared again by weight among the rest until none is above.  A source's last
use is cut so that it takes the whole part of its target exactly.

Defined results: null and wordless texts have size 0 and take 0; a source without words has target 0; rows that repeat
a doc_id each hold their own words; a null doc_id is a document like any other.  An empty table gives no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvflow.llm.common import materialise

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 64
SHARD_SLOTS = 4096
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
SEED = 42
#: Documents of a source that one task numbers, about, and the parts a source has at least.
ORDER_ROWS, ORDER_PARTS = 20_000, 64
#: Sources go through the driver (a name and three numbers each) and into the alias table; more are refused, none is lost.
MAX_SOURCES = 100_000
#: Shards whose counts one task sums up in order; their totals are summed in a second step.
SHARD_GROUP = 4096
#: Rounds of the permutation.
ROUNDS = 10
#: Slots that one task fills, about, and draws.
TASK_SLOTS, TASK_DRAWS = 100_000, 10_000_000


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> dict[str | None, float]:
    """Words each source is to give: shares by weight, none above most times its size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    got: dict[str | None, float] = {}
    left, open_ = share * sum(sizes.values()), list(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            got |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            got[s] = float(most * sizes[s])
            open_.remove(s)
        left = max(0.0, share * sum(sizes.values()) - sum(got.values()))
    return got


def _permuted(index: Column, n: Column, key: Column, backwards: bool = False) -> Column:
    """Where index goes under a keyed permutation of 0 to n - 1 (backwards: where it comes from).

    Swap-or-not rounds: each pairs x with a keyed partner k - x (mod n) and swaps the two or not by a hash of the pair,
    so a round is its own inverse and stays below n.
    """

    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        swap = F.xxhash64(key, r, F.greatest(x, partner)).bitwiseAND(1) == 1
        return F.when(swap, partner).otherwise(x)

    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if backwards else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.when(n > 1, F.aggregate(rounds, index.cast("long"), step)).otherwise(F.lit(0).cast("long"))


def _source_key(s: Column) -> Column:
    return F.xxhash64(F.coalesce(s, F.lit("")), s.isNull(), F.lit(SEED))


def _uniform(*parts: Column) -> Column:
    """In [0, 1), from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def alias_table(uses: list[int]) -> tuple[list[float], list[int]]:
    """(chance, other): of entry i of n, taken with equal chances, chance i keeps i and the rest gives other i; together
    each i comes up by its share of uses.  Made in whole numbers."""
    n, total = len(uses), sum(uses)
    left, keep, other = [u * n for u in uses], [total] * len(uses), list(range(len(uses)))
    small, large = [i for i in range(n) if left[i] < total], [i for i in range(n) if left[i] >= total]
    while small and large:
        i, k = small.pop(), large.pop()
        keep[i], other[i] = left[i], k
        left[k] -= total - left[i]
        (small if left[k] < total else large).append(k)
    return [k / total for k in keep], other


def _before(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """df (shard, by, value) with before: the running sum of value by shard, less the row's own.

    In groups of SHARD_GROUP shards, so that a task holds one group, or one sum for each group.
    """
    d = df.withColumn("group", (F.col("shard") / SHARD_GROUP).cast("long"))
    sums = d.groupBy(*by, "group").agg(F.sum(value).alias("n"))
    base = F.sum("n").over(Window.partitionBy(*(by or [F.lit(0)])).orderBy("group")) - F.col("n")
    sums = sums.select(*by, "group", base.alias("base"))
    within = F.sum(value).over(Window.partitionBy(*by, "group").orderBy("shard")) - F.col(value)
    return d.withColumn("within", within).join(sums, [*by, "group"]).withColumn("before", F.col("base") + F.col("within")).drop("group", "base", "within")


class Mix:
    """A plan over docs: tables of sources, of documents and of slots."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> None:
        self.id_col = id_col
        self.spark = docs.sparkSession
        sized = docs.select(
            F.col(id_col),
            F.col(source_col).cast("string").alias("source"),
            F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        )
        self.sized = materialise(sized, "sizes")
        rows = self.sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
        if len(rows) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        sizes = {r.source: r.size for r in rows}
        want = targets(sizes)
        self.buckets = max(ORDER_PARTS, -(-max((r.n for r in rows), default=0) // ORDER_ROWS))
        table = []
        for s in sorted(sizes, key=lambda s: (s is None, (s or "").encode())):
            size, take = sizes[s], int(want[s])
            n = -(-size // BLOCK)
            passes, rest = divmod(take, size) if size else (0, 0)
            # uses of full passes, then blocks until the rest is reached; slots may be one more than needed by the short block
            uses = passes * n + -(-rest // BLOCK) + (1 if rest else 0) if size else 0
            table.append((s, size, want[s], take, n, passes, rest, min(uses, (passes + 1) * n)))
        self.table = table
        schema = "source string, source_size long, target double, take long, n_blocks long, passes long, rest long, uses long"
        sources = self.spark.createDataFrame(table, schema).withColumn("key", _source_key(F.col("source")))
        last = F.when(F.col("n_blocks") > 0, _permuted(F.col("n_blocks") - 1, F.col("n_blocks"), F.col("key"), backwards=True))
        self.sources = sources.withColumn("last_index", last)

    def placed(self) -> DataFrame:
        """Documents with the offset of their first word in their source."""
        bucket = F.pmod(F.xxhash64(F.col(self.id_col), F.lit(SEED)), F.lit(self.buckets)).cast("int")
        d = self.sized.withColumn("bucket", bucket)
        sums = d.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), before.alias("base"))
        own = Window.partitionBy("source", "bucket").orderBy(self.id_col, "size").rowsBetween(Window.unboundedPreceding, -1)
        d = d.withColumn("within", F.coalesce(F.sum("size").over(own), F.lit(0)))
        joined = d.join(starts, d.source.eqNullSafe(starts.s) & (d.bucket == starts.b))
        return joined.select(self.id_col, d.source, "size", (F.col("base") + F.col("within")).alias("offset"))

    def drawn(self) -> DataFrame:
        """shard, source, n, first: how many slots of a shard a source fills, and the number of its first use there."""
        total = sum(t[7] for t in self.table)
        live = [t for t in self.table if t[7]]
        if not live:
            return self.spark.createDataFrame([], "shard long, source string, n long, first long")
        chance, other = alias_table([t[7] for t in live])
        at = _uniform(F.col("id"), F.lit(SEED)) * len(live)
        slots = self.spark.range(0, total, 1, max(self.spark.sparkContext.defaultParallelism, -(-total // TASK_DRAWS)))
        slots = slots.select((F.col("id") / SHARD_SLOTS).cast("long").alias("shard"), at.alias("at")).withColumn("entry", F.col("at").cast("int"))
        keeps = F.col("at") - F.col("entry") < F.get(F.from_json(F.lit(str(chance)), "array<double>"), F.col("entry"))
        which = F.when(keeps, F.col("entry")).otherwise(F.get(F.from_json(F.lit(str(other)), "array<int>"), F.col("entry")))
        counts = materialise(slots.groupBy("shard", which.alias("which")).agg(F.count("*").alias("k")), "draws")
        frame = self.spark.createDataFrame([(i, t[0], t[7]) for i, t in enumerate(live)], "which int, source string, uses long")
        ran = _before(counts, "k", ["which"]).join(F.broadcast(frame), "which")
        own = F.greatest(F.lit(0).cast("long"), F.least("k", F.col("uses") - F.col("before"))).alias("n")
        ran = materialise(ran.select("shard", "which", "k", own), "quotas")
        short = ran.groupBy("shard").agg(F.sum(F.col("k") - F.col("n")).alias("open")).where("open > 0")
        short = _before(short, "open", []).select("shard", F.col("before").alias("lo"), (F.col("before") + F.col("open")).alias("hi"))
        given = {r.which: r.k for r in counts.groupBy("which").agg(F.sum("k").alias("k")).collect()}
        lack, at = [], 0
        for i, t in enumerate(live):
            more = max(0, t[7] - given.get(i, 0))
            if more:
                lack.append((i, at, at + more))
                at += more
        filled = ran.select("shard", "which", "n")
        if lack:
            lacking = F.from_json(F.lit(json.dumps([{"which": i, "a": a, "b": b} for i, a, b in lack])), "array<struct<which:int,a:bigint,b:bigint>>")
            # A shard's open slots lie in few of the stretches that sources lack.
            met = F.filter(lacking, lambda x: (x["a"] < F.col("hi")) & (x["b"] > F.col("lo")))
            more = short.select("shard", "lo", "hi", F.explode(met).alias("l"))
            filled = filled.union(more.select("shard", "l.which", F.least("hi", "l.b") - F.greatest("lo", "l.a")))
        counts = materialise(filled.groupBy("shard", "which").agg(F.sum("n").alias("n")).where("n > 0"), "filled")
        return _before(counts, "n", ["which"]).join(F.broadcast(frame), "which").select("shard", "source", "n", F.col("before").alias("first"))

    def slots(self) -> DataFrame:
        """shard, source, use, block, words: a row for each use of a block, words counted from its start."""
        d = self.drawn()
        # Few rows stand for many slots: deal them out by the slots there are, not by their own size.
        tasks = -(-sum(t[7] for t in self.table) // TASK_SLOTS)
        d = d.repartition(max(1, tasks))
        s = F.broadcast(self.sources.withColumnRenamed("source", "s"))
        each = d.join(s, d.source.eqNullSafe(F.col("s"))).select(
            "shard", "source", "source_size", "n_blocks", "passes", "rest", "key", "last_index", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i")
        )
        each = each.withColumn("use", F.col("first") + F.col("i")).withColumn("index", F.col("use") % F.col("n_blocks"))
        each = each.withColumn("block", _permuted(F.col("index"), F.col("n_blocks"), F.col("key")))
        each = each.withColumn("length", F.least(F.lit(BLOCK), F.col("source_size") - F.col("block") * BLOCK))
        # Words of this pass before index: BLOCK each, but for the short last block where it came earlier.
        short = F.col("n_blocks") * BLOCK - F.col("source_size")
        before = F.col("index") * BLOCK - F.when(F.col("last_index") < F.col("index"), short).otherwise(0)
        final = (F.col("use") / F.col("n_blocks")).cast("long") >= F.col("passes")
        words = F.when(final, F.greatest(F.lit(0), F.least("length", F.col("rest") - before))).otherwise(F.col("length"))
        return each.select("shard", "source", "use", "block", words.cast("long").alias("words")).where("words > 0")

    def taken(self) -> DataFrame:
        """id, size, source_size, target, taken: a row for each document."""
        uses = self.slots().groupBy("source", "block", "words").agg(F.count("*").alias("times"))
        uses = uses.select(F.col("source").alias("us"), F.col("block").alias("ub"), "words", "times")
        d = materialise(self.placed().withColumn("row", F.monotonically_increasing_id()), "placed")
        first, last = (F.col("offset") / BLOCK).cast("long"), ((F.col("offset") + F.col("size") - 1) / BLOCK).cast("long")
        parts = d.where("size > 0").select("row", "source", "size", "offset", F.explode(F.sequence(first, last)).alias("block"))
        met = parts.join(uses, parts.source.eqNullSafe(F.col("us")) & (parts.block == F.col("ub")))
        lo, hi = F.greatest("offset", F.col("block") * BLOCK), F.least(F.col("offset") + F.col("size"), F.col("block") * BLOCK + F.col("words"))
        got = met.groupBy("row").agg(F.sum(F.greatest(F.lit(0), hi - lo) * F.col("times")).alias("taken"))
        s = F.broadcast(self.sources.withColumnRenamed("source", "s"))
        return d.join(got, "row", "left").join(s, d.source.eqNullSafe(F.col("s"))).select(
            self.id_col, "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
        )
