"""Features, fit and scores of the quality model against plain Python."""

import math
import random
import re

import numpy as np
import xxhash

from kvflow.llm import quality
from tests.llm.fixtures import DOCS, text


def test_shape_counts_past_24_characters():
    shape = lambda t: quality._Buckets()[t][1]
    start = "aB3-aB3-aB3-aB3-aB3-aB3-"
    assert len({shape(start + "tail"), shape(start + "1234"), shape(start + "#x#")}) == 3
    assert shape(start + "tail") == shape(start + "longer")


def plain_features(t):
    found = set()
    for token in re.findall(r"\S+", t or ""):
        word = re.sub(r"^\W+|\W+$", "", token).lower()
        kinds = ["X" if c.isupper() else "x" if c.islower() else "9" if c.isdigit() else c for c in token]
        shape = "".join(c for i, c in enumerate(kinds) if not i or c != kinds[i - 1])
        found |= {xxhash.xxh64_intdigest(k + v, 42) % quality.DIMENSIONS for k, v in (("w", word), ("s", shape)) if v}
    return sorted(found)


def test_scores_against_plain_python(spark):
    rng = random.Random(33)
    rows, labels = [], []
    for i in range(240):
        kind = i % 6
        t = text(rng, 40) + " scum trash" * (kind == 0)
        rows.append((i, " ".join(w + "##" for w in t.split()) if kind == 1 else t, None, None, None))
        labels.append((i, int(kind != 1), int(kind == 0)))
    rows += [(900, None, None, None, None), (901, " \n", None, None, None), (None, "Ab1--c ## the", None, None, None), rows[0]]
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sampled = quality.sample(docs, marks)
    grades = [0 if toxic else 2 if good else 1 for _, good, toxic in labels]
    assert [(at.tolist(), y) for at, y in sampled] == [(plain_features(rows[i][1]), grades[i]) for i in range(240)]
    model = quality.fit(sampled)
    assert (np.diff(model.thresholds) > 0).all()

    def chances(t):
        at = [b for b in plain_features(t) if model.kept[b]]
        score = sum(float(model.weights[b]) for b in at) / max(1, len(at)) ** 0.25
        return [1 / (1 + math.exp(threshold - score)) for threshold in model.thresholds]

    got = sorted((r.doc_id is None, r.doc_id or 0, r.grade, r.p_ge_1, r.p_ge_2, r.keep) for r in quality.predict(docs, model).collect())
    want = sorted((i is None, i or 0, sum(p), *p, p[0] >= 0.5) for i, t, *_ in rows for p in [chances(t)])
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:2] == b[:2] and np.allclose(a[2:5], b[2:5], atol=1e-5) and a[5] == b[5]

    def loss(m):
        total, weight = 0.0, [1 / math.sqrt(grades.count(y) / len(grades)) for y in range(3)]
        for at, y in sampled:
            p = [1.0, *m.tails(at), 0.0]
            total -= weight[y] * math.log(max(p[y] - p[y + 1], 1e-12))
        return total

    # The rated rows can be told apart, so the likelihood has no end point; the fit is far on its way from equal weights.
    assert loss(model) < loss(quality.Model(np.zeros_like(model.weights), model.kept, model.thresholds)) / 3
