"""Benchmark decontamination by winnowing.  DataFrame functions only.

Texts become words (A-Z lower-cased; runs of ASCII letters and digits and anything beyond ASCII).  From every WINDOW
consecutive words the K-word gram with the least hash is kept, the same one wherever the window stands, so a shared
span of WINDOW words always shares a kept gram: WINDOW - K + 1 grams start in it.  Kept grams of documents are joined
to those of the benchmark; each match is extended to the windows around it, and these are compared word for word, so
no hash decides.  Items of fewer than WINDOW words are one window each and are found by their longest word.

The benchmark side is broadcast only where its row count is at most BROADCAST_ROWS; beyond it grams are shuffled and
documents with a match are joined once more to their words.

Defined results: null has no words and is never hit; items without a word are ignored; repeated document rows give
equal results; repeated items count once each by item_id.  An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvflow.llm.common import NON_WORD, ROW_KEY, lower_ascii, materialise, with_row_key, words

WINDOW = 10
K = 6
#: Grams whose windows share one kept gram.  winnowed() is made for K = 2 + 4 and SPAN = 1 + 4.
SPAN = WINDOW - K + 1
#: Bits of a gram's place: any array's.
PLACE_BITS = 31
PLACE_MASK = (1 << PLACE_BITS) - 1
BROADCAST_ROWS = 500_000


def tokens(text: Column) -> Column:
    return words(lower_ascii(text), NON_WORD)


def _held(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value made once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _paired(a: Column, b: Column, by: int, merge: Callable[[Column, Column], Column]) -> Column:
    """merge of each element of a and the one that stands by places further on in b; beyond b's end of nothing."""
    return F.zip_with(a, F.slice(b, by + 1, F.greatest(F.size(b) - by, F.lit(0))), lambda x, y: merge(x, y))


def winnowed(col: str) -> Column:
    """The kept grams of the words in col, each once: in every SPAN consecutive grams, the last of those with the least hash.

    A kept gram is one number: the upper 33 bits of its hash, then its place counted from the end of the range, so the
    least number of a window is the least hash and, among equals, the last place.  Empty under WINDOW words.

    Each word is hashed once; hashes of 2, 4 and K words, and minima over 2, 4 and SPAN grams, are made of pairs.
    """
    grams = F.size(col) - (K - 1)

    def of_words(h: Column) -> Column:
        return _held(_paired(h, h, 1, F.xxhash64), lambda two: _paired(_paired(two, two, 2, F.xxhash64), two, 4, F.xxhash64))

    def numbered(k: Column) -> Column:
        return F.transform(F.slice(k, 1, F.greatest(grams, F.lit(0))), lambda x, i: x.bitwiseOR(F.lit(PLACE_MASK).cast("long")).bitwiseXOR(i.cast("long")))

    def least(k: Column) -> Column:
        return _held(_paired(k, k, 1, F.least), lambda two: _paired(_paired(two, two, 2, F.least), k, 4, F.least))

    kept = _held(F.transform(col, lambda w: F.xxhash64(w)), lambda h: _held(numbered(of_words(h)), least))
    kept = F.array_distinct(F.slice(kept, 1, F.greatest(grams - SPAN + 1, F.lit(0))))
    return F.when(F.size(col) >= WINDOW, kept).otherwise(F.array().cast("array<bigint>"))


def _place(kept: str) -> Column:
    return (F.lit(PLACE_MASK) - F.col(kept).bitwiseAND(PLACE_MASK)).cast("int")


def _gram(kept: str) -> Column:
    return F.shiftright(kept, PLACE_BITS)


def _windows(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(long, short): item_id with the words of each full window and its start; with the words of each item too short for one."""
    w = materialise(items.select(F.col(item_id).alias("item_id"), tokens(F.col(text)).alias("w")).where(F.size("w") > 0), "items")
    return w.where(F.size("w") >= WINDOW), w.where(F.size("w") < WINDOW)


def _few(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _occurring(
    docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id: str, item_text: str, broadcast: bool | None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tokenised rows, occurrences: row key, start, n, window; owned: item_id, window)."""
    long_items, short_items = _windows(items, item_id, item_text)
    kept = long_items.select(F.explode(winnowed("w")).alias("kept"))
    grams = materialise(kept.select(_gram("kept").alias("gram")).distinct(), "grams")
    anchor = F.array_max(F.transform("w", lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("back"), x.alias("x"))))
    short = short_items.select("w", anchor.alias("a")).select("w", F.col("a.x").alias("anchor"), (-F.col("a.back")).alias("offset")).distinct()
    short = materialise(short, "short-items")
    is_short = bool(short.limit(1).count())

    rows = with_row_key(docs.select(F.col(id_col), F.col(text_col).alias("text")), id_col)
    tokenised = rows.select(id_col, *ROW_KEY, tokens(F.col("text")).alias("w"))
    small = (_few(grams) and _few(short)) if broadcast is None else broadcast
    near = F.broadcast if small else (lambda df: df)

    placed = tokenised.select(*ROW_KEY, *(["w"] if small else []), F.explode(winnowed("w")).alias("kept"))
    placed = placed.withColumns({"at": _place("kept"), "gram": _gram("kept")}).drop("kept")
    matched = placed.join(near(grams), "gram", "left_semi")
    if not small:
        matched = matched.join(tokenised.select(*ROW_KEY, "w").dropDuplicates(ROW_KEY), ROW_KEY)
    first, last = F.greatest(F.col("at") - (SPAN - 1), F.lit(0)), F.least(F.col("at"), F.size("w") - WINDOW)
    around = F.transform(F.sequence(first, last), lambda s: F.struct(s.cast("int").alias("start"), F.array_join(F.slice("w", s + 1, WINDOW), " ").alias("window")))
    candidates = matched.select(*ROW_KEY, F.explode(around).alias("c")).select(*ROW_KEY, "c.start", "c.window").distinct()
    starts = F.sequence(F.lit(1), F.size("w") - WINDOW + 1)
    owned = long_items.select("item_id", F.explode(F.transform(starts, lambda s: F.array_join(F.slice("w", s, WINDOW), " "))).alias("window")).distinct()
    length = F.lit(WINDOW)
    if is_short:
        one = tokenised.select(*ROW_KEY, *(["w"] if small else []), F.posexplode("w").alias("at", "anchor")).join(near(short.withColumnRenamed("w", "q")), "anchor")
        if not small:
            one = one.join(tokenised.select(*ROW_KEY, "w").dropDuplicates(ROW_KEY), ROW_KEY)
        one = one.withColumn("start", (F.col("at") - F.col("offset")).cast("int")).where("start >= 0")
        one = one.where(F.slice("w", F.greatest(F.col("start"), F.lit(0)) + 1, F.size("q")) == F.col("q"))
        candidates = candidates.union(one.select(*ROW_KEY, "start", F.array_join("q", " ").alias("window")).distinct())
        owned = owned.union(short_items.select("item_id", F.array_join("w", " ").alias("window")).distinct())
        length = F.size(F.split("window", " "))

    occurring = candidates.join(owned.select("window").distinct(), "window", "left_semi").withColumn("n", length)
    return tokenised, materialise(occurring, "occurring"), owned


def flags(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The row keys (common.with_row_key) of contaminated documents, each once."""
    return _occurring(docs, items, id_col, text_col, item_id, item_text, None)[1].select(*ROW_KEY).distinct()


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", broadcast: bool | None = None
) -> DataFrame:
    """id_col, n_words, n_hit, n_items, items_sha256, contaminated: a row for each row of docs.

    broadcast: None lets the benchmark's size decide.
    """
    tokenised, occurring, owned = _occurring(docs, items, id_col, text_col, item_id, item_text, broadcast)
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1))))
    hits = occurring.select(*ROW_KEY, F.struct("start", "n").alias("span")).groupBy(*ROW_KEY).agg(F.collect_set("span").alias("spans"))
    hits = hits.select(*ROW_KEY, F.size(covered).cast("long").alias("n_hit"))
    found = occurring.select(*ROW_KEY, "window").distinct().join(owned, "window").select(*ROW_KEY, "item_id").distinct()
    listed = found.groupBy(*ROW_KEY).agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("ids"))
    listed = listed.select(*ROW_KEY, F.size("ids").cast("long").alias("n_items"), F.array_join("ids", ",").alias("ids"))
    summed = hits.join(listed, ROW_KEY, "left")
    counted = tokenised.select(id_col, *ROW_KEY, F.size("w").cast("long").alias("n_words"))
    return counted.join(summed, ROW_KEY, "left").select(
        id_col,
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


_TOKENS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
ORACLE_SQL = f"""
with d as (select doc_id, {_TOKENS} as w from documents),
b as (select item_id, {_TOKENS} as w from benchmark),
q as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as win
  from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)
),
s as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from q) where len(w) >= n)),
o as (select s.doc_id, s.n, s.i, q.item_id from s join q on s.n = q.n and s.win = q.win),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from o) group by doc_id),
l as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from o) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join l using (doc_id)
"""
