"""Sharding by a k-d tree over document metadata: shards of near equal bytes.

A node that is to hold several shards is cut at the weighted median (the point that gives each side its part of the
node's bytes) along its widest metadata dimension, until each leaf is one shard of the target bytes.  A place along a
dimension is the share of all bytes before it, in 0 ... 4095: of smaller numbers (on a log scale of 4096 bins), or of
heavier values of a string (4096 hash bins, the one with most bytes first).  So widths compare, and a node is widest
where it spans the most of the corpus.  Rows equal in the dimension are told apart by a hash of their id and text, and
rows that repeat in full by the file and row they stand in, so a value that a third of all rows share is cut as finely
as any other.

Medians are found from histograms: four rounds of at most 4096 bins for each open node, first by the dimension, then by
12 bits of the ties at a time.  Running sums and the bins that cross a median are found in Spark; one row a node and
the 4096 bins of each dimension reach the driver, however many rows there are.  Rows never sort together.

Defined results: law ``bytes``; grown_shard is null.  A null text has 8 bytes and a null crc; null metadata stands
before all else; rows that repeat in full are rows of their own and may part.  An empty table gives no rows.  Extra
columns are ignored, or carried as they are.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kvflow.llm.common import materialise

SHARDS = 24
MAX_SHARDS = 4096
BINS = 4096
DIMENSIONS = ("n_chars", "source", "lang")
#: Bytes a row counts for besides its text.
ROW_BYTES = 8
#: Rows and bytes that one task numbers, about.
SLOT_ROWS, SLOT_BYTES = 500_000, 16 << 20


def _binned(df: DataFrame, names: list[str]) -> list[Column]:
    """Each dimension as a bin from 0 to BINS - 1; null is bin 0 and nothing else is."""
    numeric = [c for c in names if isinstance(df.schema[c].dataType, T.NumericType)]
    logs = {c: F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0))) for c in numeric}
    ends = df.agg(*[f(logs[c]).alias(f"{c}_{f.__name__}") for c in numeric for f in (F.min, F.max)]).first() if numeric else None
    out = []
    for c in names:
        if c in logs:
            low, high = ends[f"{c}_min"] or 0.0, ends[f"{c}_max"] or 0.0
            value = (logs[c] - low) / (high - low) * (BINS - 2) if high > low else F.lit(0)
        else:
            value = F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(BINS - 1))
        out.append(F.when(F.col(c).isNull(), 0).otherwise(1 + value.cast("int")))
    return out


def _shares(rows: DataFrame, bins: list[str], numeric: list[bool]) -> list[list[int]]:
    """For each dimension the place of each of its bins: the bytes of the bins before it, of BINS parts of all bytes."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("d"), F.col(c).alias("bin")) for i, c in enumerate(bins)]))
    held = rows.select("size", each.alias("x")).groupBy("x.d", "x.bin").agg(F.sum("size").alias("bytes")).collect()
    out = []
    for i, is_number in enumerate(numeric):
        own = sorted(((0 if is_number or r.bin == 0 else -r.bytes, r.bin, r.bytes) for r in held if r.d == i), key=lambda r: (r[1] != 0, r[0], r[1]))
        places, before, total = [0] * BINS, 0, sum(r[2] for r in own)
        for _, at, size in own:
            places[at] = before * BINS // total
            before += size
        out.append(places)
    return out


def _lookup(values: list[int], at: Column) -> Column:
    """values[at], from a constant array."""
    return F.get(F.from_json(F.lit(str(values)), "array<bigint>"), at.cast("int"))


def _place(dim: Column, dims: list[str]) -> Column:
    """The row's 48-bit place along the dimension of index dim."""
    return F.get(F.array(*dims), dim.cast("int")).cast("long") * (BINS**3) + F.col("tie") * BINS + F.col("sub")


class _Tree:
    """Nodes as parallel lists.  left is -1 for a node without a cut; the right child is left + 1."""

    def __init__(self, shards: int) -> None:
        self.leaves, self.first, self.left, self.dim, self.cut = [shards], [0], [-1], [0], [0]

    def split(self, node: int, dim: int, cut: int) -> None:
        k, at = self.leaves[node], len(self.leaves)
        self.left[node], self.dim[node], self.cut[node] = at, dim, cut
        for n, first in ((k // 2, self.first[node]), (k - k // 2, self.first[node] + k // 2)):
            self.leaves.append(n)
            self.first.append(first)
            self.left.append(-1)
            self.dim.append(0)
            self.cut.append(0)

    def node(self, dims: list[str], depth: int) -> Column:
        """The node a row falls into after depth cuts: one walk down, however deep, so the plan doesn't grow."""
        if not depth:
            return F.lit(0)

        def step(n: Column, _: Column) -> Column:
            below = _lookup(self.left, n) + (_place(_lookup(self.dim, n), dims) > _lookup(self.cut, n)).cast("long")
            return F.when(_lookup(self.left, n) < 0, n).otherwise(below)

        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0).cast("long"), step).cast("int")


def _cuts(rows: DataFrame, leaves: dict[int, int], dims: list[str]) -> dict[int, tuple[int, int]]:
    """For each open node with rows: the index of its widest dimension, and the largest place of its left part.

    rows: node, the dimensions, tie, sub, size.
    """
    open_ = rows.where(F.col("node").isin(list(leaves)))
    ends = open_.groupBy("node").agg(*[(F.max(d) - F.min(d)).alias(d) for d in dims], F.sum("size").alias("bytes")).collect()
    if not ends:
        return {}
    widest = {r.node: max(range(len(dims)), key=lambda i: (r[dims[i]], -i)) for r in ends}
    # Twice the bytes wanted on the left side of a leaf's share, in whole numbers.
    want = {r.node: (2 * r.bytes * (leaves[r.node] // 2) + leaves[r.node]) // (2 * leaves[r.node]) for r in ends}
    most = max(widest) + 1
    of = lambda values, default: _lookup([values.get(n, default) for n in range(most)], F.col("node"))
    open_ = open_.select("node", "size", _place(of(widest, 0), dims).alias("place"))
    at: dict[int, int] = {}
    base = dict.fromkeys(widest, 0)
    for width in (BINS**3, BINS**2, BINS, 1):
        within = open_
        if at:
            within = open_.where(F.shiftright("place", (width * BINS).bit_length() - 1) == of(at, -1))
        hist = within.groupBy("node", F.shiftright("place", width.bit_length() - 1).alias("bin")).agg(F.sum("size").alias("bytes"))
        upto = of(base, 0) + F.sum("bytes").over(Window.partitionBy("node").orderBy("bin"))
        crossed = hist.withColumn("upto", upto).groupBy("node").agg(
            # The first bin past the median; the last of all where none is.
            F.coalesce(F.min(F.when(F.col("upto") > of(want, 0), F.struct("bin", "upto", "bytes"))), F.max(F.struct("bin", "upto", "bytes"))).alias("x")
        )
        for r in crossed.select("node", "x.*").collect():
            at[r.node], base[r.node] = r.bin, r.upto - r.bytes
            if width == 1 and abs(r.upto - want[r.node]) > abs(base[r.node] - want[r.node]):
                at[r.node] -= 1
    return {n: (widest[n], at[n]) for n in widest}


def _numbered(docs: DataFrame) -> DataFrame:
    """docs with row_place: a number that tells repeated rows apart and stays when a task is run again."""
    try:
        return docs.withColumn("row_place", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    except AnalysisException:  # not read from files: written, so that it is
        return materialise(docs, "shard-input").withColumn("row_place", F.xxhash64("_metadata.file_path", "_metadata.row_index"))


def assign(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", dimensions: tuple[str, ...] = DIMENSIONS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """id_col, size, text_crc32, law, shard, slot, grown_shard, and the columns carry: a row for each row of docs."""
    if not 1 <= shards <= MAX_SHARDS:
        raise ValueError(f"shards must be 1 to {MAX_SHARDS}")
    dims = [c for c in dimensions if c in docs.columns]
    names = [f"k{i}" for i in range(len(dims))]
    plain = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        *[F.col(c).alias(f"m{i}") for i, c in enumerate(dims)],
        *([F.struct(*[F.col(c).alias(c) for c in carry]).alias("carried")] if carry else []),
    )
    plain = _numbered(plain)
    metadata = [f"m{i}" for i in range(len(dims))]
    described = plain.select(
        "id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64("id", "text"), F.lit(BINS * BINS)).alias("tie"),
        F.pmod("row_place", F.lit(BINS)).alias("sub"),
        *[b.cast("int").alias(f"b{i}") for i, b in enumerate(_binned(plain, metadata))],
        *(["carried"] if carry else []),
    )
    rows = materialise(described.drop("carried"), "shard-rows")
    bins = [f"b{i}" for i in range(len(dims))]
    shares = _shares(rows, bins, [isinstance(docs.schema[c].dataType, T.NumericType) for c in dims]) if dims else []

    def placed_by(df: DataFrame) -> DataFrame:
        return df.withColumns({n: _lookup(places, F.col(b)).cast("int") for n, b, places in zip(names, bins, shares, strict=True)}).drop(*bins) if dims else df.withColumn("k0", F.lit(0))

    rows, described = placed_by(rows), placed_by(described)
    names = names or ["k0"]
    tree, depth = _Tree(shards), 0
    while open_ := {n: k for n, k in enumerate(tree.leaves) if k > 1 and tree.left[n] < 0}:
        cuts = _cuts(rows.select(tree.node(names, depth).alias("node"), *names, "tie", "sub", "size"), open_, names)
        if not cuts:
            break
        for n in open_:
            tree.split(n, *cuts.get(n, (0, -1)))
        depth += 1
    shard = _lookup(tree.first, tree.node(names, depth)).cast("int").alias("shard")
    placed = rows.select("tie", "sub", "size", shard)
    final = (described if carry else rows).select("id", "size", "text_crc32", "tie", "sub", shard, *(["carried"] if carry else []))
    return _slotted(final, placed).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        *(["carried.*"] if carry else []),
    )


def _slotted(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0, in parts of about SLOT_ROWS and SLOT_BYTES: no task holds a whole shard.

    placed: tie, sub, size and shard of the same rows, cheap to read.
    """
    most = placed.groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).agg(F.max("n"), F.max("bytes")).first()
    parts = max(1, -(-(most[0] or 0) // SLOT_ROWS), -(-(most[1] or 0) // SLOT_BYTES))
    part = F.pmod(F.xxhash64("tie", "sub"), F.lit(parts)).cast("int").alias("part")
    sums = placed.groupBy("shard", part).count()
    starts = sums.select("shard", "part", (F.sum("count").over(Window.partitionBy("shard").orderBy("part")) - F.col("count")).alias("start"))
    own = Window.partitionBy("shard", "part").orderBy("id", "tie", "sub")
    within = rows.withColumn("part", part).withColumn("within", F.row_number().over(own) - 1)
    return within.join(starts, ["shard", "part"]).withColumn("slot", (F.col("start") + F.col("within")).cast("long"))
