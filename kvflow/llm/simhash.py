"""SimHash near-duplicate groups by multi-index hashing.

A 64-bit fingerprint is two segments of 32 bits.  Two fingerprints that differ in at most 4 bits differ in at most 2
in one of the segments.  So each distinct fingerprint is filed, for each segment, under every value in the Hamming
ball of radius 1 around its own; two values at distance 2 meet in the balls' common points.  Those who meet in a table
entry are verified on all 64 bits.  An entry's members are searched breadth first and give the edges of a spanning
forest, never all pairs, so a group of g near copies gives g - 1 edges an entry.

An entry with over ENTRY_LIMIT members doesn't go through one task: its members are filed under every 64-bit value in
the ball of radius 2 around them (2081 each).  Any two that share such a value differ in at most 4 bits, and any two
that differ in at most 4 share one, so linking each member to the least of its value is exact and linear.

Defined results: a null or wordless text has fingerprint zero and links like any other; a text of fewer than 4 words
is one shingle; equal rows share a component; a null doc_id gets the component of its fingerprint's other rows and
null where there are none.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvflow.llm.common import materialise
from kvflow.llm.components import connected_components

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
#: Distinct fingerprints under one table entry that one task compares.
ENTRY_LIMIT = 20_000
#: Shingles whose bits are summed at once.
BLOCK = 1 << 16


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of the 4-word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()
    width = min(SHINGLE, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(line[starts[i] : stops[i + width]], SEED) for i in range(n)), np.uint64, n))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes (uint64); zero of none."""
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        set_bits += np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and fp (the fingerprint's bits as a long), a row for each row of docs."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], [id_col, "fp"])

    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def _table_entries(distinct: DataFrame) -> DataFrame:
    """entry, fp: each fingerprint under the 33 values around each of its segments.  Bit 32 of entry names the segment."""
    low = F.col("fp").bitwiseAND(0xFFFFFFFF)
    high = F.shiftrightunsigned("fp", 32).bitwiseAND(0xFFFFFFFF).bitwiseOR(1 << 32)
    masks = F.array(*[F.lit(m).cast("long") for m in [0, *(1 << b for b in range(32))]])
    entries = F.concat(F.transform(masks, lambda m: low.bitwiseXOR(m)), F.transform(masks, lambda m: high.bitwiseXOR(m)))
    return distinct.select("fp", F.explode(entries).alias("entry"))


def spanning_edges(fps: np.ndarray, most: int = MAX_DISTANCE) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints (uint64), found breadth first."""
    edges = []
    rest = fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= most
            if near.any():
                found = rest[near]
                rest = rest[~near]
                edges += [(int(at), int(x)) for x in found]
                queue += list(found)
    return edges


def _compare_entries(limit: int):
    """Over partitions sorted by entry: edges a-b among an entry's members; b is null for each member of an entry over the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int | None]] = []
        seen: set[tuple[int, int]] = set()
        held: list[np.ndarray] = []
        size, open_entry, over = 0, None, False

        def close() -> None:
            nonlocal held, size, over
            if held and not over and size > 1:
                for edge in spanning_edges(np.unique(np.concatenate(held).view(np.uint64))):
                    if edge not in seen:
                        if len(seen) >= 500_000:
                            seen.clear()
                        seen.add(edge)
                        out.append(edge)
            held, size, over = [], 0, False

        def add(part: np.ndarray) -> None:
            nonlocal held, size, over
            size += len(part)
            if not over and size > limit:
                over = True
                out.extend((int(x), None) for x in np.concatenate([*held, part]).view(np.uint64))
                held = []
            elif over:
                out.extend((int(x), None) for x in part.view(np.uint64))
            else:
                held.append(part)

        def ready() -> pa.RecordBatch:
            a = np.array([x for x, _ in out], np.uint64).view(np.int64)
            b = [None if y is None else (y if y < 1 << 63 else y - (1 << 64)) for _, y in out]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            entry, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(entry):
                continue
            cuts = np.flatnonzero(np.diff(entry)) + 1
            starts, stops = np.r_[0, cuts], np.r_[cuts, len(entry)]
            # Alone inside the batch: no partner.  The first and last run may go on in another batch.
            runs = np.flatnonzero((stops - starts > 1) | (starts == 0) | (stops == len(entry)))
            for k in runs:
                first = entry[starts[k]]
                if first != open_entry:
                    close()
                    open_entry = first
                add(fp[starts[k] : stops[k]])
            if len(out) >= 100_000:
                yield ready()
        close()
        if out:
            yield ready()

    return run


def _ball_edges(crowded: DataFrame) -> DataFrame:
    """Links by shared points of balls of radius 2: exact and linear, for the members of crowded entries."""
    flips = [0, *(1 << b for b in range(64)), *((1 << b) | (1 << c) for b, c in combinations(range(64), 2))]
    signed = [m if m < 1 << 63 else m - (1 << 64) for m in flips]
    masks = F.from_json(F.lit(str(signed)), "array<bigint>")
    points = crowded.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("b"))
    return points.join(least, "point").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def link(distinct: DataFrame, entry_limit: int = ENTRY_LIMIT) -> DataFrame:
    """distinct: fp, each once.  Edges a-b that span every group of fingerprints linked at MAX_DISTANCE or fewer bits."""
    entries = _table_entries(distinct).select("entry", "fp")
    dealt = entries.repartition("entry").sortWithinPartitions("entry", "fp")
    found = materialise(dealt.mapInArrow(_compare_entries(entry_limit), "a long, b long"), "links")
    edges = found.where("b is not null")
    if found.where("b is null").limit(1).count():
        crowded = found.where("b is null").select(F.col("a").alias("fp")).distinct()
        edges = edges.union(_ball_edges(crowded))
    return edges


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", entry_limit: int = ENTRY_LIMIT) -> DataFrame:
    """id_col, fingerprint (16 hex digits), component_id, n_same (rows with this very fingerprint), a row for each row of docs."""
    rows = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = materialise(rows.groupBy("fp").agg(F.min(id_col).alias("rep"), F.count("*").alias("n_same")), "distinct")
    edges = link(distinct.select("fp"), entry_limit)
    groups = connected_components(edges)
    placed = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = placed.where("component <> fp or rep is not null").groupBy("component").agg(F.min("rep").alias("component_id"))
    by_fp = placed.join(least, "component", "left").select("fp", "component_id", "n_same")
    return rows.join(by_fp, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_same")
