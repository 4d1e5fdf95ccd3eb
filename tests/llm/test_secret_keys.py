"""Candidate keys over the whole base64 alphabet, texts of very many matches, and all spans against SQL."""

import hashlib
import random
import time

from kvflow.llm import secretscan
from tests.llm.fixtures import DOCS, against_sql, documents


def test_base64_keys(spark):
    key, copied = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "q3/Zt8+LmX0vKe7/RbYw2+HnJ5sPd9UcAoTgF1iQ6r4="
    path = "usr/local/lib/python3/Site/packages/Report2024/summary"
    url = "https://www.example.org/Docs/en/2024/annual/report/Page12"
    rows = [
        (1, f"aws_secret_access_key = {key}", "en", "a", 1),
        *[(10 + i, f"see {copied} here", "en", f"s{i}", 1) for i in range(5)],
        (20, f"{path} {url}", "en", "a", 1),
        (21, "data 9f/Ab+3kQ/x7LmZ+0pWs2Tq/8uVr==.", "en", "b", 1),
    ]
    got = {r.doc_id: r for r in secretscan.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1].spans == f"token:24:{24 + len(key)}" and got[1].n_live == 1
    assert all(got[10 + i].spans == "" and got[10 + i].n_copied == 1 for i in range(5))
    assert got[20].spans == ""
    assert got[21].spans == "token:5:35" and got[21].n_live == 1


def test_all_spans_against_sql(spark, tmp_path):
    rng = random.Random(4)
    key = lambda n: "".join(rng.choice("abcXYZ0189+/_-=") for _ in range(n))
    shared = [key(rng.randrange(20, 60)) for _ in range(12)]
    words = ["token=", "Password: ", "AKIA" + "Z9" * 9, "deadbeef" * 4, "é", "𝒳 ", " ", "/", "=", '"']
    extra = [
        (500 + i, "".join(rng.choice(words) if rng.random() < 0.6 else rng.choice([rng.choice(shared), key(rng.randrange(5, 50))]) for _ in range(rng.randrange(60))), None, rng.choice(["a", "b", "c", "d", None]), 1)
        for i in range(150)
    ]
    docs = documents(spark, 20, extra=[*extra, *extra[:3]])
    found = secretscan.scan(docs)
    assert found.where("n_live > 0").count() and found.where("n_copied > 0").count()
    against_sql(tmp_path, found, secretscan.ORACLE_SQL, documents=docs)
    assert secretscan.scan(docs.limit(0)).count() == 0
    by_column = secretscan.scan(docs, repository_cols=("source", "lang"))
    assert by_column.count() == docs.count()


def test_a_text_of_very_many_matches(spark):
    n = 50_000
    rows = [(1, "token=abcdef1 " * n, "en", "a", 1), (2, "0123456789abcdef01234567 " * n, "en", "a", 1), (3, "token=abcdef1", "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    begun = time.monotonic()
    got = {r.doc_id: r for r in secretscan.scan(docs).collect()}
    assert time.monotonic() - begun < 60
    assert got[1].n_assign == got[2].n_hex == n
    assert got[1].base_sha256 == hashlib.sha256(",".join(f"assign:{14 * i}:{14 * i + 13}" for i in range(n)).encode()).hexdigest()
    assert got[2].spans == ",".join(f"hex:{25 * i}:{25 * i + 24}" for i in range(n))
