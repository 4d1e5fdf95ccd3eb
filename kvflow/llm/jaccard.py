"""Near-duplicate groups by Jaccard similarity of word shingles: SimHash and MinHash candidates, all verified.

A text is the set of its SHINGLE-word shingles, hashed to 64 bits.  Candidates come from simhash's multi-index search
over the fingerprints of these sets, which finds texts that differ little, and, since a pair at 0.8 differs in 10 of 64
bits on average and so mostly escapes it, from BANDS bands of ROWS minima: two texts of similarity 0.8 share no band in
5 cases of a million, those above in fewer.  Texts that share a band or are near by fingerprint are joined to candidate
groups (each to the least of its kind, so linearly).  The sets themselves are then compared: any text of similarity
LEAST to one of s shingles holds one of any s - ceil(LEAST * s) + 1 of them, so the rarest so many give all that it has
to be compared with.

A candidate group is dealt to parts of about PART_TEXTS texts and PART_SHINGLES shingles, a task each; HUBS of its
texts go to all its parts and tie what belongs together.  Where parts are still apart after that, each two that hold
more than one class are compared in a task of their own.  So every pair of a group is compared or known to be linked,
and no task's size grows with a group.

Texts with equal sets are one node from the start.

Defined results: null and wordless texts have the empty set and are equal; a text of fewer than SHINGLE words is one
shingle; equal rows share a component; a null id gets the component of its group's other rows and null where there are
none.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvflow.llm import simhash
from kvflow.llm.common import ROW_KEY, materialise, with_row_key
from kvflow.llm.components import connected_components

SHINGLE = 5
#: Least similarity of linked texts, as a fraction.
LEAST = (4, 5)
BANDS, ROWS = 40, 6
SEED = 42
#: Shingles whose minima are taken at once.
BLOCK = 1 << 12
#: Of a candidate group: texts and shingles of one part, about, and the texts that all its parts share.
PART_TEXTS, PART_SHINGLES, HUBS = 512, 1 << 20, 8

_random = np.random.default_rng(SEED)
_FACTORS = _random.integers(0, 1 << 31, (BANDS * ROWS, 1)).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _random.integers(0, 1 << 32, (BANDS * ROWS, 1)).astype(np.uint32)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of a text's distinct shingles, ascending."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - SHINGLE + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()
    width = min(SHINGLE, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[starts[i] : stops[i + width]], SEED) for i in range(n)), np.uint64, n))


def bands(hashes: np.ndarray) -> list[int]:
    """One number (signed 64 bits) for each band; the band's place is part of it."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), BLOCK):
        np.minimum(least, (short[None, at : at + BLOCK] * _FACTORS + _SHIFTS).min(axis=1), out=least)
    raw, width = least.tobytes(), 4 * ROWS
    return np.array([xxhash.xxh64_intdigest(raw[i * width : (i + 1) * width], i) for i in range(BANDS)], np.uint64).view(np.int64).tolist()


def _node(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def clusters(sets: list[np.ndarray]) -> list[int]:
    """For each set the index of the first set that it is linked to, through others or directly, at LEAST or more."""
    up, down = LEAST
    size = np.array([len(s) for s in sets])
    ends = np.cumsum(size)
    begins = ends - size
    _, ids, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    holders = np.repeat(np.arange(len(sets)), size)[np.argsort(ids, kind="stable")]
    upto = np.cumsum(held)
    marked = np.zeros(len(held), bool)
    label = np.full(len(sets), -1)
    left = len(sets)
    for first in range(len(sets)):
        if label[first] >= 0:
            continue
        label[first], queue, left = first, [first], left - 1
        while queue and left:
            at = queue.pop()
            own = ids[begins[at] : ends[at]]
            rare = own[np.argsort(held[own], kind="stable")[: len(own) - -(-up * len(own) // down) + 1]]
            met = np.unique(np.concatenate([holders[upto[g] - held[g] : upto[g]] for g in rare])) if len(rare) else np.flatnonzero(size == 0)
            met = met[(label[met] < 0) & (size[met] * down >= up * size[at]) & (size[at] * down >= up * size[met])]
            if not len(met):
                continue
            marked[own] = True
            both = np.array([np.count_nonzero(marked[ids[begins[x] : ends[x]]]) for x in met])
            marked[own] = False
            near = met[both * (up + down) >= up * (size[at] + size[met])]
            label[near] = first
            left -= len(near)
            queue += near.tolist()
    return label.tolist()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t.as_py()) for t in batch.column(batch.num_columns - 1)]
        nodes = np.array([_node(h) for h in found], np.uint64).view(np.int64)
        fps = np.array([simhash.majority(h) for h in found], np.uint64).view(np.int64)
        columns = [pa.array(nodes, pa.int64()), pa.array(fps, pa.int64()), pa.array([len(h) for h in found], pa.int64()), pa.array([bands(h) for h in found], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], "node", "fp", "n", "bands"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over partitions sorted by part: edges a-b of each node to one that it is linked to, none where it is the first."""
    open_part: int | None = None
    held: dict[int, np.ndarray] = {}

    def close() -> pa.RecordBatch:
        nodes = list(held)
        label = clusters(list(held.values()))
        held.clear()
        linked = [(n, nodes[i]) for n, i in zip(nodes, label, strict=True) if n != nodes[i]]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in linked], pa.int64()) for k in (0, 1)], ["a", "b"])

    for batch in batches:
        for part, node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if part != open_part:
                if held:
                    yield close()
                open_part = part
            if node not in held:
                held[node] = shingles(text.as_py())
    if held:
        yield close()


def _compared(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges a-b found inside each part.  members: part, node and the row key of a text with the node's set."""
    # Members grow with the texts: one plan at every size.
    met = texts.join(materialise(members, "members").hint("merge"), ROW_KEY).select("part", "node", "text")
    return met.repartition("part").sortWithinPartitions("part").mapInArrow(_verify, "a long, b long")


def _candidates(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges a-b that span the candidate groups.  rows: node, bands; nodes: node, fp."""
    entries = rows.select("node", F.explode("bands").alias("entry"))
    least = entries.groupBy("entry").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b < most")
    by_band = entries.join(least.select("entry", "b").hint("merge"), "entry").where("node <> b").select(F.col("node").alias("a"), "b")
    prints = materialise(nodes.groupBy("fp").agg(F.min("node").alias("b")), "prints")
    same = nodes.join(prints, "fp").where("node <> b").select(F.col("node").alias("a"), "b")
    near = simhash.link(prints.select("fp"))
    near = near.join(prints.select(F.col("fp").alias("a"), F.col("b").alias("of_a")), "a").join(prints.select(F.col("fp").alias("b"), F.col("b").alias("of_b")), "b")
    return by_band.union(same).union(near.select("of_a", "of_b"))


def _linked(candidates: DataFrame, texts: DataFrame, part_texts: int, part_shingles: int) -> DataFrame:
    """node, component of the texts linked at LEAST or more.  candidates: candidate, node, n, row key, each node once."""
    sizes = candidates.groupBy("candidate").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    parts = F.greatest(F.ceil(F.col("members") / part_texts), F.ceil(F.col("shingles") / part_shingles)).cast("int")
    sizes = materialise(sizes.select("candidate", "members", parts.alias("parts")), "candidate-sizes")
    dealt = candidates.join(sizes, "candidate").withColumn("i", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = materialise(dealt, "dealt")

    def name(*by: str) -> Column:
        return F.xxhash64("candidate", *by).alias("part")

    several = dealt.where("parts > 1")
    # HUBS of a group's texts, more or less, by hash.
    hubs = several.where(F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("members")) < HUBS)
    everywhere = hubs.select("candidate", "node", *ROW_KEY, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"))
    members = dealt.select(name("i"), "node", *ROW_KEY).union(everywhere.select(name("i"), "node", *ROW_KEY))
    edges = materialise(_compared(members, texts), "part-links")
    found = connected_components(edges)
    if not several.limit(1).count():
        return found

    # Parts that still hold classes apart: each two of them that could be linked meet in a task.
    known = several.join(found, "node", "left").select("candidate", "parts", "i", "node", F.coalesce("component", "node").alias("class"), *ROW_KEY)
    known = materialise(known, "part-classes")
    apart = known.groupBy("candidate").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    ends = known.join(apart.select("candidate"), "candidate", "left_semi").groupBy("candidate", "i").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    ends = materialise(ends, "part-ends")
    two = ends.alias("x").join(ends.alias("y"), (F.col("x.candidate") == F.col("y.candidate")) & (F.col("x.i") < F.col("y.i")))
    two = two.where("least(x.low, y.low) < greatest(x.high, y.high)").select("x.candidate", F.col("x.i").alias("i"), F.col("y.i").alias("j"))
    two = materialise(two, "part-pairs")
    if not two.limit(1).count():
        return found
    sides = two.select("candidate", "i", name("i", "j")).union(two.select("candidate", "j", name("i", "j")))
    members = known.join(sides, ["candidate", "i"]).select("part", "node", *ROW_KEY)
    return connected_components(edges.union(_compared(members, texts)))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_texts: int = PART_TEXTS, part_shingles: int = PART_SHINGLES) -> DataFrame:
    """id_col, the row key (common.with_row_key) and component (a number for each group): a row for each row of docs."""
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = with_row_key(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")), id_col, "text")
    schema = f"`{id_col}` {kind}, rk_null boolean, rk_id long, rk_text long, node long, fp long, n long, bands array<long>"
    rows = materialise(keyed.select(id_col, *ROW_KEY, "text").mapInArrow(_signatures, schema), "signatures")
    nodes = materialise(rows.groupBy("node", "fp", "n").agg(F.min(F.struct(*ROW_KEY)).alias("row")), "nodes")
    candidates = connected_components(_candidates(rows, nodes)).withColumnRenamed("component", "candidate")
    chosen = materialise(candidates.join(nodes, "node").select("candidate", "node", "n", "row.*"), "candidates")
    linked = _linked(chosen, keyed.select(*ROW_KEY, "text"), part_texts, part_shingles)
    placed = nodes.select("node").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Written, so that the join deals both sides anew and a set that very many rows share can be split over tasks.
    return rows.select(id_col, *ROW_KEY, "node").join(materialise(placed, "placed"), "node").drop("node")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_texts: int = PART_TEXTS, part_shingles: int = PART_SHINGLES) -> DataFrame:
    """id_col, component_id (least id of the group): a row for each row of docs."""
    found = materialise(groups(docs, id_col, text_col, part_texts, part_shingles), "groups")
    least = found.groupBy("component").agg(F.min(id_col).alias("component_id"))
    return found.join(materialise(least, "least"), "component").select(id_col, "component_id")
