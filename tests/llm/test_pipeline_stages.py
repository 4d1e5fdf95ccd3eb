"""What the stages of the pipeline owe beyond running: near copies, delivered words, rejected text."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kvflow.llm import jaccard, mixing
from tests.llm.fixtures import DOCS, text


def shingles(s):
    w = s.lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def similar(a, b):
    a, b = shingles(a), shingles(b)
    return 5 * len(a & b) >= 4 * len(a | b)


def lexicon(rng, n):
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(n)]


def test_near_duplicates_of_similarity_0_8(spark):
    rng = random.Random(21)
    pool = lexicon(rng, 500)
    rows = []
    for i in range(40):
        words = [rng.choice(pool) for _ in range(100)]
        edited, far = list(words), list(words)
        edited[20] = edited[50] = "edited"  # 10 of 96 shingles differ
        for k in (10, 30, 50, 70, 90):
            far[k] = "far"
        rows += [(3 * i, " ".join(words), "en", "a", 1), (3 * i + 1, " ".join(edited), "en", "a", 1), (3 * i + 2, " ".join(far), "en", "a", 1)]
    texts = {r[0]: r[1] for r in rows}
    for i in range(40):
        assert similar(texts[3 * i], texts[3 * i + 1]) and not similar(texts[3 * i], texts[3 * i + 2]) and not similar(texts[3 * i + 1], texts[3 * i + 2])
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, DOCS), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in texts if i % 3 != 1)


def test_near_duplicate_groups_are_single_links(spark):
    rng = random.Random(22)
    words = [rng.choice(lexicon(rng, 90)) for _ in range(120)]
    rows = []
    for i in range(30):  # a chain: neighbours are alike, its ends are not
        rows.append((100 - i, " ".join(words), "en", "a", 1))
        words[rng.randrange(120)] = f"new{i}"
    rows += [(7, "Lone", None, None, None), (8, "lone", None, None, None), (9, None, None, None, None), (11, " ", None, None, None), (None, rows[0][1], None, None, None), (12, text(rng, 3000), None, None, None)]
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    want = {r[0]: r[0] for r in rows if r[0] is not None}
    for _ in rows:
        for i, s, *_ in rows:
            for k, t, *_ in rows:
                if None not in (i, k, s, t) and s.strip() and t.strip() and similar(s, t):
                    want[i] = want[k] = min(want[i], want[k])
    want[11] = 9
    assert got == want | {None: want[100]}


def test_mix_meets_each_sources_target(spark):
    rng = random.Random(23)
    rows = [(i, text(rng, rng.choice([20, 90, 800, 2000, 2500])), "en", "hot" if i % 3 == 0 else rng.choice("abcd"), 1) for i in range(300)]
    rows += [(None, text(rng, 700), "en", "hot", 1) for _ in range(20)] + [(1000, None, "en", None, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    held, given, longest = Counter(), Counter(), Counter()
    for _, s, _, source, _ in rows:
        n = len((s or "").split())
        held[source] += n
        longest[source] = max(longest[source], n)
    for r in corpus_pipeline.mix_sources(spark, docs, "").collect():
        given[r.source] += len(r.text.split())
    want = mixing.targets(dict(held))
    assert any(0.3 < want[s] / held[s] < 0.9 for s in held if held[s])
    for s in held:
        assert abs(given[s] - want[s]) <= longest[s], s


def test_language_stage_rejects_other_languages_and_gibberish(spark):
    rng = random.Random(24)
    en = "the of and to in that is was he for it with as his on be at by had not are but from or have an they which one you were her all she there would their we him been has when who will more no if out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over man me even most made after also did many before must through back years where much your way well down should because each just those people how too little state good very make world still own see men work long get here between both life being under never day same another know while last might us great old year off come since against go came right used take three".split()
    de = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei hatte kann gegen vom können schon wenn habe seine mark ihre dann unter wir soll ich eines jahr zwei jahren diese dieser wieder keine uhr seiner worden will zwischen immer millionen was sagte gibt alle seit muss doch jetzt waren drei".split()
    rows = [(i, " ".join(rng.choice(en if i % 2 else de) for _ in range(rng.choice([4, 12, 60, 300]))), "en" if i % 2 else "de", "a", 1) for i in range(200)]
    finnish = "vuonna suomen tasavallan hallitus päätti että kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on toimittava toisiaan kohtaan veljeyden hengessä"
    letters = "abcdefghijklmnopqrstuvwxyz"
    mixed = letters + letters.upper() + "0123456789+/"
    bad = [finnish, finnish[:90], *["".join(rng.choice(mixed) for _ in range(n)) for n in (64, 400)]]
    bad += [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 11))) for _ in range(n)) for n in (40, 300)]
    docs = spark.createDataFrame(rows + [(1000 + i, s, None, "a", 1) for i, s in enumerate(bad)], DOCS)
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in rows]


@pytest.mark.parametrize("part_texts", [3, 1000])
def test_near_duplicates_dealt_to_parts(spark, part_texts):
    rng = random.Random(25)
    pool, rows = lexicon(rng, 400), []
    for group in range(4):  # edits of one text: alike to it, and hardly to one another
        words = [rng.choice(pool) for _ in range(100)]
        rows.append((1000 + group, " ".join(words)))
        for i in range(25):
            edited = list(words)
            for k in rng.sample(range(100), 2):
                edited[k] = f"e{i}"
            rows.append((100 * group + i, " ".join(edited)))
    rows += [(2000 + i, " ".join(rng.choice(pool) for _ in range(rng.choice([1, 4, 30])))) for i in range(30)] + [(3000, rows[0][1]), (None, rows[0][1])]
    rng.shuffle(rows)
    least = {i: i for i, _ in rows if i is not None}
    links = [(i, k) for i, s in rows for k, t in rows if None not in (i, k) and i < k and similar(s, t)]
    for _ in rows:
        for i, k in links:
            least[i] = least[k] = min(least[i], least[k])
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"part": F.lit("x"), "fp": F.lit(1), "bands": F.lit(2)})
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs, part_texts=part_texts).collect()}
    assert got == least | {None: least[3000]}


def odd(spark):
    """Documents with nulls, repeats and columns of any name."""
    rng = random.Random(26)
    same = text(rng, 60)
    rows = [(5, text(rng, 70), "en", "a", 1), (5, text(rng, 80), "en", "a", 1), (6, text(rng, 90), "en", "b", 1), (1, same, "en", "a", 1), (None, same, "en", "a", 1), (None, text(rng, 65), "en", None, 1)]
    rows += [rows[5], rows[5], (7, None, None, None, None), (8, "", "en", "a", 0), (9, text(rng, 5000), "en", "b", 1), (10, text(rng, 40), None, None, None), rows[2], (6, rows[2][1], "de", "c", None)]
    names = ("score", "lang_pred", "text_to_score", "copy", "times", "size", "Shard", "rk_id", "rk_text", "doc", "mix_key", "node", "component", "floor", "d0", "part", "carried", "shard_doc")
    return spark.createDataFrame(rows, DOCS).withColumns({n: F.lit(f"own {n}") for n in names}), rows


def test_stages_on_odd_rows(spark, tmp_path):
    docs, rows = odd(spark)
    spark.createDataFrame([(1, "nothing of the kind stands in any of these documents at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    shown = lambda df: Counter((r.doc_id, r.text, r.lang) for r in df.collect())
    every = shown(docs)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path))
        assert got.limit(0).count() == 0 and stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        assert name == "sharding" or got.columns == docs.columns
        out[name] = got
    assert {r.Shard for r in out["language"].collect()} == {"own Shard"}
    assert shown(out["language"]) == Counter({k: n for k, n in every.items() if k[1]})
    near = shown(out["near-dedup"])
    assert sorted((i is None, i or 0) for i, *_ in near) == [(False, i) for i in (1, 5, 5, 6, 7, 9, 10)] + [(True, 0)] and set(near.values()) == {1}
    assert {k[1] for k in near} == {k[1] for k in every} - {""}
    assert shown(out["decontamination"]) == every
    given, held, longest = Counter(), Counter(), Counter()
    for r in out["mixing"].collect():
        given[r.source] += len(r.text.split())
        assert r.mix_key == "own mix_key"
    for _, s, _, source_name, _ in rows:
        held[source_name] += len((s or "").split())
        longest[source_name] = max(longest[source_name], len((s or "").split()))
    want = mixing.targets(dict(held))
    assert all(abs(given[s] - want[s]) <= longest[s] for s in held)
    assert max(shown(out["mixing"])[k] / n for k, n in every.items()) <= 2
    assert shown(out["sharding"]) == every
    assert {"size_in", "Shard_in", "size", "shard", "slot", "law", "carried"} <= set(out["sharding"].columns)
    assert {(r.size_in, r.Shard_in) for r in out["sharding"].collect()} == {("own size", "own Shard")}


def test_documents_of_one_id_all_have_their_say(spark):
    docs = spark.createDataFrame([(5, "a one two three", "en", "s", 1), (5, "b four five six", "en", "s", 1), (6, "c seven eight nine", "en", "s", 1)], DOCS)
    assert corpus_pipeline.drop_near_duplicates(spark, docs, "").count() == 3
    nulls = spark.createDataFrame([(1, "a a", None, None, None), (None, "a a", None, None, None), (None, "b b", None, None, None), (None, "b b", None, None, None)], DOCS)
    assert sorted(r.text for r in corpus_pipeline.drop_near_duplicates(spark, nulls, "").collect()) == ["a a", "b b"]
