"""Small tables with the awkward rows every operator must take."""

import random
from collections import Counter

import duckdb

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the and onesen erblest at hein ti inenan eranenes whou therouou thon heoron eratsh blees sh esheon erstlyat eronthwh reer anat tisher".split()


def text(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", ",\n"]) for _ in range(n))


def documents(spark, n=60, seed=3, extra=()):
    """n documents with nulls in every column, empty and long texts, copies, near copies, repeated rows; clashing extra columns."""
    rng = random.Random(seed)
    rows = [(i, text(rng, rng.choice([3, 30, 120])), rng.choice(["en", "de"]), rng.choice(["a", "a", "b", "c", None]), 1) for i in range(n)]
    rows += [
        (n, None, None, None, None),
        (n + 1, "", "en", "a", 0),
        (n + 2, " \n\t", "en", "a", 3),
        (n + 3, text(rng, 30_000), "en", "b", 9),
        (n + 4, rows[0][1], "en", "a", 1),
        (n + 5, rows[0][1].upper(), None, "b", 1),
        (n + 6, rows[1][1] + " tail", "en", "a", 1),
        rows[2],
        (None, rows[3][1], "en", "a", 1),
        (None, None, None, None, None),
        (n + 7, "x" * 50_000, "en", "c", 1),
        (n + 8, "İstanbul ÀÉ ß 𝒳 tail", "de", "c", 1),
        *extra,
    ]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    return df.withColumns({"size": F.lit("extra"), "keep_id": F.lit(1), "score": F.lit("x"), "w": F.lit(0), "node": F.lit(0), "shard": F.lit(7), "source_size": F.lit(0)})


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def against_sql(tmp_path, found, sql, **tables):
    """Assert that found has the rows that DuckDB gives for sql over the tables (name=DataFrame)."""
    con = duckdb.connect()
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        con.execute(f"create view {name} as select * from '{tmp_path / name}/*.parquet'")
    want = con.execute(sql).fetchall()
    columns = [c[0] for c in con.description]

    def shown(row):
        return tuple(f"{x:.9f}" if isinstance(x, float) else str(x) for x in row)

    got = Counter(shown(r) for r in found.select(columns).collect())
    assert got == Counter(map(shown, want))
