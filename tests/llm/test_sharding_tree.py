"""The k-d tree cut again in plain Python, and the law of near equal bytes on repeated rows."""

import math
import random
from collections import Counter

from kvflow.llm import sharding
from tests.llm.fixtures import DOCS, text
from tests.llm.test_mixing_plan import signed, xx


def plain_tree(rows, shards):
    """Shard of each (doc_id, text, lang, source, n_chars); ids and texts differ."""
    size = [len((t or "").encode()) + 8 for _, t, *_ in rows]
    logs = [None if r[4] is None else math.log1p(max(r[4], 0)) for r in rows]
    low, high = min(x for x in logs if x is not None), max(x for x in logs if x is not None)
    bins = [[0 if x is None else 1 + (int((x - low) / (high - low) * 4094) if high > low else 0) for x in logs]]
    bins += [[0 if r[k] is None else 1 + signed(xx(r[k])) % 4095 for r in rows] for k in (3, 2)]
    dims = []
    for d, own in enumerate(bins):
        held = Counter()
        for b, n in zip(own, size, strict=True):
            held[b] += n
        place, before = {}, 0
        for b in sorted(held, key=lambda b: (b != 0, 0 if d == 0 else -held[b], b)):
            place[b] = before * 4096 // sum(size)
            before += held[b]
        dims.append([place[b] for b in own])
    tie = [signed(xx(None if i is None else ("long", i), t)) % (1 << 24) for i, t, *_ in rows]
    out = {}

    def cut(members, leaves, first):
        if leaves == 1 or not members:
            out.update(dict.fromkeys(members, first))
            return
        widest = max(range(3), key=lambda d: (max(dims[d][m] for m in members) - min(dims[d][m] for m in members), -d))
        order = sorted(members, key=lambda m: (dims[widest][m], tie[m]))
        total = sum(size[m] for m in members)
        want = (2 * total * (leaves // 2) + leaves) // (2 * leaves)
        left, before = len(order), 0
        for k, m in enumerate(order):
            if before + size[m] > want:
                left = k + (abs(before + size[m] - want) <= abs(before - want))
                break
            before += size[m]
        cut(order[:left], leaves // 2, first)
        cut(order[left:], leaves - leaves // 2, first + leaves // 2)

    cut(list(range(len(rows))), shards, 0)
    return out


def test_tree_against_plain_python(spark):
    rng = random.Random(41)
    rows = [(i, text(rng, rng.choice([2, 20, 200])) + f" {i}", rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "a", "b", "c"]), rng.choice([10, 100, 5000, None])) for i in range(250)]
    rows += [(None, "no id", "en", "a", 3), (1000, None, None, None, None), (1001, "", "en", "hot", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    for shards in (2, 7):
        want = plain_tree(rows, shards)
        got = {r.doc_id: r.shard for r in sharding.assign(docs, shards).collect()}
        assert got == {rows[k][0]: shard for k, shard in want.items()}


def test_repeated_rows_part(spark):
    same = spark.range(300).selectExpr("1L as doc_id", "'t' as text", "'en' as lang", "'s' as source", "1L as n_chars")
    rows = sharding.assign(same, 4).collect()
    assert sorted(Counter(r.shard for r in rows)) == [0, 1, 2, 3] and max(Counter(r.shard for r in rows).values()) <= 1.15 * 75
    for shard in range(4):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
