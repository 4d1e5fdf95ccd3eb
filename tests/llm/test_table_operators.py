"""URL filter, sharding, exact dedup, mixing, quality and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kvflow.llm import common, exactdedup, mixing, quality, sharding, urlfilter
from tests.llm.fixtures import DOCS, against_sql, ascii_lower, documents, rows_of, text


def test_chunks_make_the_text(spark):
    docs = documents(spark, 10)
    rows = docs.select("text", F.array_join(exactdedup.chunks(common.lower_ascii(F.coalesce("text", F.lit("")))), "").alias("joined")).collect()
    assert all(ascii_lower(r.text or "") == r.joined for r in rows)


@pytest.mark.parametrize("clash", ["none", "few", "many"])
def test_exact_dedup(spark, clash):
    docs = documents(spark, 30)
    options = {"none": {}, "few": {"identify": lambda c: F.length(c) % 7}, "many": {"identify": lambda c: F.length(c) % 7, "max_clashes": 1}}[clash]
    if "identify" in options:
        own = options["identify"]
        options["identify"] = lambda c: own(c).cast("long")
    got = exactdedup.duplicate_groups(docs, **options).collect()
    groups = defaultdict(list)
    for i, t in rows_of(docs):
        groups[ascii_lower(t or "")].append(i)
    want = Counter()
    for t, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, best, len(ids), i == best, hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == want
    assert exactdedup.duplicate_groups(docs.limit(0)).count() == 0


def test_targets():
    t = mixing.targets({"b": 100, "a": 10, None: 100, "c": 1000})
    assert t["a"] == 20 and t["b"] <= 200 and math.isclose(sum(t.values()), 1.5 * 1210)
    assert t[None] == 200 and mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0}


def test_permutation(spark):
    for n in (1, 2, 3, 17, 64, 1000):
        df = spark.range(n).select("id", mixing._permuted(F.col("id"), F.lit(n).cast("long"), F.lit(12345).cast("long")).alias("p"))
        back = df.select("id", "p", mixing._permuted(F.col("p"), F.lit(n).cast("long"), F.lit(12345).cast("long"), True).alias("b")).collect()
        assert sorted(r.p for r in back) == list(range(n)) and all(r.b == r.id for r in back)
        assert n < 17 or [r.p for r in back] != list(range(n))


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 16)
    docs = documents(spark, 50)
    mix = mixing.Mix(docs)
    got = mix.taken().collect()
    assert len(got) == docs.count()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += size(r.text)
    want = mixing.targets(dict(sizes))
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == int(want[s]) for s in sizes)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, mixing.Mix(docs.repartition(3)).taken().collect()))
    slots = mix.slots().collect()
    assert sum(r.words for r in slots) == sum(taken.values())
    assert len({(r.source, r.use) for r in slots}) == len(slots)
    assert max(Counter((r.source, r.block) for r in slots).values()) <= 2
    used = defaultdict(set)
    for r in slots:
        used[r.shard].add(r.source)
    assert max(map(len, used.values())) >= 3
    assert mixing.Mix(docs.limit(0)).taken().count() == 0
    assert mixing.Mix(docs.where("text is null")).taken().first().taken == 0


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_sharding(spark, shards):
    rng = random.Random(2)
    rows = [(1000 + i, text(rng, rng.randrange(20, 60)), "en", "hot" if i % 3 else "b", 7) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS).union(documents(spark, 4).select("doc_id", "text", "lang", "source", "n_chars").where("length(text) < 5000 or text is null"))
    got = sharding.assign(docs, shards).collect()
    assert len(got) == docs.count() and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    texts = {i: t for i, t in rows_of(docs)}
    total = defaultdict(int)
    for r in got:
        if r.doc_id is not None:
            t = texts[r.doc_id]
            assert r.size == len((t or "").encode()) + 8 and r.text_crc32 == (None if t is None else zlib.crc32(t.encode()))
        total[r.shard] += r.size
    assert set(total) == set(range(shards))
    assert max(total.values()) <= 1.15 * sum(total.values()) / shards
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = {(r.doc_id, r.size, r.shard) for r in sharding.assign(docs.repartition(7), shards).collect()}
    assert again == {(r.doc_id, r.size, r.shard) for r in got}


def test_sharding_of_odd_tables(spark):
    docs = documents(spark, 10)
    assert sharding.assign(docs, 24).count() == docs.count()
    assert sharding.assign(docs, 3, dimensions=()).count() == docs.count()
    same = spark.range(300).selectExpr("1L as doc_id", "'t' as text", "'en' as lang", "'s' as source", "1L as n_chars")
    assert sharding.assign(same, 4).count() == 300
    assert sharding.assign(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(docs, 0)


def rule_of(host, path):
    fits = []
    for v, r in urlfilter.RULES:
        h, _, p = r.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(r), r, v))
    return max(fits)[1:] if fits else (None, None)


def test_url_filter(spark, tmp_path):
    rng = random.Random(8)
    urls = [f"https://{rng.choice(['www', 'spam', 'blog'])}.{rng.choice(['x', 'example'])}.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.randrange(300)}?q=1" for _ in range(300)]
    urls += [None, "", "nothing", "http://", "HTTP://EXAMPLE.ORG", "x://Example.org/es/#a/b", "a://b.com?x=/fr/", "u://h.org/p://q", "http://notorg/", "https://deep.sub.example.org/en/15#t", urls[0]]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"score": F.lit("x"), "cut": F.lit(0), "gram": F.lit(1)})
    got = {r.page_id: r for r in urlfilter.judge(pages).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            host, path = re.match(r"([^/?#]*)([^?#]*)", u.partition("://")[2]).groups()
        host = ascii_lower(host)
        rule, verdict = rule_of(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        if verdict:
            assert got[i].verdict == verdict
        elif not u or "://" not in u:
            assert got[i].verdict == "block"

    against_sql(tmp_path, urlfilter.judge(pages), urlfilter.ORACLE_SQL, pages=pages)
    free = [r for r in got.values() if r.rule is None and urls[r.page_id] and "://" in urls[r.page_id]]
    low = max((r.score for r in free if r.verdict == "block"), default=-9)
    assert low <= min(r.score for r in free if r.verdict == "allow")
    assert {r.verdict for r in urlfilter.judge(pages.where("url like '%.net/%'")).collect()} == {"allow"}
    assert urlfilter.judge(pages.limit(0)).count() == 0


def test_quality(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        kind = i % 8
        t = text(rng, 60)
        if kind == 0:
            t += " scum trash " + t
        elif kind in (1, 2):
            t = " ".join(w + "###" for w in t.split())
        rows.append((i, t, None, None, None))
        if i % 2 == 0 or kind < 3:
            labels.append((i, int(kind not in (1, 2)), int(kind == 0)))
    rows += [(900, None, None, None, None), (901, "", None, None, None), rows[0], (None, "the and", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("grade", F.lit("clash"))
    marks = spark.createDataFrame(labels + [(5, None, None), (None, 1, 0), (7777, 1, 0), labels[0]], "doc_id long, quality int, toxic int")
    sampled = quality.sample(docs, marks, 150)
    assert len(sampled) in (149, 150)  # 7777 has no document
    model = quality.fit(sampled)
    got = quality.predict(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.p_ge_2 <= r.p_ge_1 <= 1 and math.isclose(r.grade, r.p_ge_1 + r.p_ge_2) for r in got)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].keep == (i % 8 != 0) for i in range(400))
    assert all((by_id[i].p_ge_2 >= 0.5) == (i % 8 > 2) for i in range(400) if i % 8)
    assert quality.predict(docs.limit(0), model).count() == 0
    for only, want in (([], 2), ([(np.array([1], np.int32), 0)], 0)):
        tails = quality.fit(only).tails(np.array([1], np.int32))
        assert round(tails.sum()) == want


def test_pipeline(spark, tmp_path):
    rng = random.Random(12)
    passage = text(rng, 30)
    rows = [(i, text(rng, 80), "en", rng.choice("ab"), 1) for i in range(80)]
    rows += [(80, rows[3][1], "en", "a", 1), (81, rows[4][1] + " x", "en", "a", 1), (82, "12 34", "en", "a", 1), (83, None, None, None, None), (84, "hello " + passage, "en", "b", 1), rows[5], (None, text(rng, 50), "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    columns, seen = docs.columns, []
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        at = common.materialise(stage(spark, at, str(tmp_path)), name)
        seen.append(at)
        assert at.columns[: len(columns)] == columns
        if name != "sharding":
            assert at.columns == columns
    language, near, clean, mixed, sharded = ([r.doc_id for r in d.collect()] for d in seen)
    assert set(range(80)) <= set(language) and 82 not in language and 83 not in language
    assert 80 not in near and len(near) == len(set(near)) and 5 in near and set(near) <= set(language)
    assert set(clean) == set(near) - {84}
    assert set(mixed) <= set(clean) and max(Counter(mixed).values()) == 2
    assert Counter(sharded) == Counter(mixed)
    ran = corpus_pipeline.run(spark, str(tmp_path)).select(*columns, "shard", "size").collect()
    assert Counter(map(tuple, ran)) == Counter(map(tuple, seen[-1].select(*columns, "shard", "size").collect()))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
