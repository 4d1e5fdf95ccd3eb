"""The mixing plan, drawn and taken again in plain Python."""

import random
import re
import struct
from collections import Counter, defaultdict
from fractions import Fraction

import xxhash

from kvflow.llm import mixing
from tests.llm.fixtures import documents


def xx(*parts):
    """Spark's xxhash64, unsigned: ("long", n), ("int", n) or text; None is skipped."""
    seed = 42
    for p in parts:
        if p is None:
            continue
        data = p.encode() if isinstance(p, str) else struct.pack({"long": "<q", "int": "<i"}[p[0]], p[1])
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def permuted(x, n, key):
    if n <= 1:
        return 0
    for r in range(1, mixing.ROUNDS + 1):
        partner = (signed(xx(("long", key), ("int", r))) % n - x) % n
        if xx(("long", key), ("int", r), ("long", max(x, partner))) & 1:
            x = partner
    return x


def test_alias_table_keeps_shares():
    rng = random.Random(5)
    for _ in range(30):
        uses = [rng.choice([1, 3, 50, 10_000]) for _ in range(rng.randrange(1, 40))]
        keep, other = mixing.alias_table(uses)
        got = [Fraction(0)] * len(uses)
        for i, (k, o) in enumerate(zip(keep, other, strict=True)):
            got[i] += Fraction(k)
            got[o] += 1 - Fraction(k)
        assert all(abs(float(g / len(uses)) - u / sum(uses)) < 1e-12 for g, u in zip(got, uses, strict=True))


def test_plan_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 16)
    monkeypatch.setattr(mixing, "SHARD_GROUP", 3)
    docs = documents(spark, 60)
    mix = mixing.Mix(docs)
    rows = [(r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")), r.source) for r in docs.collect()]
    held, count = Counter(), Counter()
    for _, n, source in rows:
        held[source] += n
        count[source] += 1
    want = mixing.targets(dict(held))
    order = sorted(held, key=lambda s: (s is None, s or ""))
    buckets = max(mixing.ORDER_PARTS, -(-max(count.values()) // mixing.ORDER_ROWS))
    bucket = lambda i: signed(xx(None if i is None else ("long", i), ("int", mixing.SEED))) % buckets

    # What each document gives: its words' blocks, pass by pass, until the target is reached.
    taken, uses = Counter(), {}
    for source in order:
        own = sorted(((bucket(i), i is not None, i or 0, n) for i, n, s in rows if s == source))
        words = [k for k, (*_, n) in enumerate(own) for _ in range(n)]
        blocks = [words[a : a + mixing.BLOCK] for a in range(0, len(words), mixing.BLOCK)]
        key = signed(xx(source or "", ("int", int(source is None)), ("int", mixing.SEED)))
        left, u = int(want[source]), 0
        while left > 0:
            some = blocks[permuted(u % len(blocks), len(blocks), key)][:left]
            left -= len(some)
            u += 1
            for k in some:
                _, known, i, n = own[k]
                taken[i if known else None, n, source, k] += 1
        uses[source] = u
        for k, (_, known, i, n) in enumerate(own):
            taken[i if known else None, n, source, k] += 0
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or "", r[3])
    assert sorted(((r.doc_id, r.size, r.source, r.taken) for r in mix.taken().collect()), key=key) == sorted(((i, n, s, t) for (i, n, s, _), t in taken.items()), key=key)

    # How many slots of each shard a source gets: drawn, cut at its uses, and the open slots given to those short of theirs.
    live = [(t[0], t[7]) for t in mix.table if t[7]]
    assert all(uses[s] <= n <= uses[s] + 1 for s, n in live)
    keep, other = mixing.alias_table([n for _, n in live])
    total = sum(n for _, n in live)
    left = [n for _, n in live]
    got, open_ = defaultdict(Counter), []
    for slot in range(total):
        at = (xx(("long", slot), ("int", mixing.SEED)) >> 11) / (1 << 53) * len(live)
        which = int(at) if at - int(at) < keep[int(at)] else other[int(at)]
        if left[which]:
            left[which] -= 1
            got[slot // 16][which] += 1
        else:
            open_.append(slot // 16)
    for shard, which in zip(open_, [i for i, n in enumerate(left) for _ in range(n)], strict=True):
        got[shard][which] += 1
    drawn = mix.drawn().collect()
    assert {(r.shard, r.source): r.n for r in drawn} == {(shard, live[w][0]): n for shard, c in got.items() for w, n in c.items()}
    first = Counter()
    for r in sorted(drawn, key=lambda r: r.shard):
        assert r.first == first[r.source]
        first[r.source] += r.n
