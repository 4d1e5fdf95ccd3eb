"""License scans by diagonal voting.

Rolling word k-gram hashes of every document are joined to the places of the same grams in license templates.  A hit
at document word p and template word q votes for the diagonal p - q; on one diagonal a template stands unbroken.  Votes
are summed by (document, template, diagonal), neighbouring diagonals are merged (an inserted or dropped word moves the
rest of a template to the next one), and the merged span is verified: a short phrase must have every gram of one
diagonal, a long notice must have MIN_COVER of its words matched.  A diagonal is merged with the one of most matched
words near it (the least of equals), and near is so defined that a span is at most MAX_STRETCH times its template and
DIAGONAL_GAP words long: chance hits beside a notice stay out of its span or in one of their own.  Hash hits are compared
word for word in the join, so no hash decides.

Templates are a constant of this module or a parameter of at most MAX_TEMPLATE_WORDS words, so their side is broadcast.

Defined results: null counts as empty; rows that repeat in full give equal results; a document without a hit has
empty labels, null first_word and last_word, score 0.  An empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvflow.llm.common import NON_WORD, ROW_KEY, lower_ascii, materialise, with_row_key, words

#: Phrase -> label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Label -> opening words of public license notices.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl-line": "this work is licensed under the gnu general public license version 3",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "zlib": "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "bsl": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software",
    "epl": "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at",
    "mit-terms": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-terms": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "gpl-terms": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    "bsd-terms": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
}
#: Notices whose label is written in another way.
ALIASES = {"gpl-line": "gpl", "mit-terms": "mit", "apache-terms": "apache", "gpl-terms": "gpl", "bsd-terms": "bsd"}
PHRASE_K, NOTICE_K = 2, 4
MIN_COVER = 0.6
#: Verified spans are at most this many times the template's length, and this many words.
MAX_STRETCH, DIAGONAL_GAP = 1.5, 6
#: Above any document's number of words.
MOST_WORDS = 1 << 31
MAX_TEMPLATE_WORDS = 20_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def templates(phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> list[tuple[int, str, bool, list[str]]]:
    """(template, label, is_phrase, words)."""
    found = [(p, label, True) for p, label in phrases.items()] + [(n, ALIASES.get(label, label), False) for label, n in notices.items()]
    out = [(i, label, is_phrase, _WORD.findall(text.lower())) for i, (text, label, is_phrase) in enumerate(found)]
    if sum(len(t[3]) for t in out) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have over {MAX_TEMPLATE_WORDS} words")
    if any(len(t[3]) < (PHRASE_K if t[2] else NOTICE_K) for t in out):
        raise ValueError(f"a phrase needs {PHRASE_K} words and a notice {NOTICE_K}")
    return out


def _places(spark, listed: list[tuple[int, str, bool, list[str]]]) -> DataFrame:
    """hash, template, q, gram: a row for each gram of each template."""
    rows = []
    for t, _, is_phrase, w in listed:
        k = PHRASE_K if is_phrase else NOTICE_K
        rows += [(t, q, w[q : q + k]) for q in range(len(w) - k + 1)]
    df = spark.createDataFrame(rows, "template int, q int, gram array<string>")
    return df.select(F.xxhash64("gram").alias("hash"), "template", "q", "gram")


def _gram(k: int) -> Column:
    """Hash of the k words from place p; null where the text ends before."""
    return F.when(F.col("p") + k <= F.size("w"), F.xxhash64(F.slice("w", F.col("p") + 1, k)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", listed: list[tuple[int, str, bool, list[str]]] | None = None) -> DataFrame:
    """id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, spans: a row for each row of docs.

    spans: array of (label, start, stop, cover) of the notices found, words from 0, stop exclusive.
    """
    listed = templates() if listed is None else listed
    spark = docs.sparkSession
    about = spark.createDataFrame([(t, label, p, len(w)) for t, label, p, w in listed], "template int, label string, is_phrase boolean, n int")
    rows = with_row_key(docs.select(F.col(id_col), F.col(text_col).alias("text")), id_col)
    tokenised = rows.select(id_col, *ROW_KEY, words(lower_ascii(F.col("text")), NON_WORD).alias("w"))
    placed = tokenised.select(*ROW_KEY, "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("p")).where(F.size("w") > 0)
    grams = placed.select(*ROW_KEY, "w", "p", F.explode(F.array(_gram(PHRASE_K), _gram(NOTICE_K))).alias("hash")).where("hash is not null")
    met = grams.join(F.broadcast(_places(spark, listed)), "hash")
    met = met.where(F.slice("w", F.col("p") + 1, F.size("gram")) == F.col("gram"))
    votes = met.groupBy(*ROW_KEY, "template", (F.col("p") - F.col("q")).alias("diagonal")).agg(F.collect_set("q").alias("q"))
    votes = materialise(votes.join(F.broadcast(about), "template"), "votes")

    whole = votes.where(F.col("is_phrase") & (F.size("q") == F.col("n") - PHRASE_K + 1))
    base = whole.groupBy(*ROW_KEY).agg(
        F.countDistinct("template", "diagonal").alias("n_base"),
        F.min("diagonal").alias("first_word"),
        F.max("diagonal").alias("last_word"),
        F.collect_set("label").alias("base"),
    )
    notices = _merged(votes.where(~F.col("is_phrase")))
    extra = notices.groupBy(*ROW_KEY).agg(
        F.collect_set("label").alias("more"),
        F.max("cover").alias("cover"),
        F.sort_array(F.collect_set(F.struct("label", "start", "stop", "cover"))).alias("spans"),
    )
    none = F.array().cast("array<string>")
    base_labels, more = F.coalesce("base", none), F.coalesce("more", none)
    out = tokenised.select(id_col, *ROW_KEY, F.size("w").cast("long").alias("n_words")).join(base, ROW_KEY, "left").join(extra, ROW_KEY, "left")
    return out.select(
        id_col,
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, more)), ",").alias("labels"),
        F.when(F.size(base_labels) > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
        F.coalesce("spans", F.array().cast("array<struct<label:string,start:int,stop:int,cover:double>>")).alias("spans"),
    )


def _merged(votes: DataFrame) -> DataFrame:
    """Notices that stand in a document, after neighbouring diagonals are merged: label, start, stop, cover."""
    matched = F.array_distinct(F.flatten(F.transform("q", lambda q: F.sequence(q, q + NOTICE_K - 1))))
    own = votes.select(*ROW_KEY, "template", "label", "n", "diagonal", matched.alias("at"))
    # As far to either side as half of what a span may be longer than its template.
    far = F.col("n") * ((MAX_STRETCH - 1) / 2) + DIAGONAL_GAP / 2
    near = Window.partitionBy(*ROW_KEY, "template").orderBy(F.col("diagonal") / far).rangeBetween(-1, 1)
    best = F.max(F.size("at").cast("long") * MOST_WORDS - F.col("diagonal")).over(near)
    merged = own.withColumn("span", best).groupBy(*ROW_KEY, "template", "label", "n", "span").agg(
        F.flatten(F.collect_list("at")).alias("at"),
        F.min(F.col("diagonal") + F.array_min("at")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("at") + 1).alias("stop"),
    )
    return merged.withColumn("cover", F.size(F.array_distinct("at")) / F.col("n")).where(F.col("cover") >= MIN_COVER)


def _sql_templates() -> str:
    rows = [f"({t}, '{label}', {is_phrase}, {w})" for t, label, is_phrase, w in templates()]
    return f"(values {', '.join(rows)}) as v(template, label, is_phrase, words)"


_TOKENS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
ORACLE_SQL = f"""
with t as (select template, label, is_phrase, words, len(words) as n, case when is_phrase then {PHRASE_K} else {NOTICE_K} end as k from {_sql_templates()}),
g as (select template, k, q, array_to_string(words[q + 1:q + k], ' ') as gram from (select *, unnest(range(n - k + 1)) as q from t)),
d as (select row_number() over () as r, doc_id, {_TOKENS} as w from documents),
p as (select r, k, p, array_to_string(w[p + 1:p + k], ' ') as gram from (select r, w, unnest(range(len(w))) as p from d), (values ({PHRASE_K}), ({NOTICE_K})) as ks(k) where p + k <= len(w)),
votes as (select r, template, p - q as diagonal, list(distinct q) as q from p join g using (k, gram) group by all),
base as (select r, count(*) as n_base, min(diagonal) as first_word, max(diagonal) as last_word, list(distinct label) as base
  from votes join t using (template) where is_phrase and len(q) = n - {PHRASE_K} + 1 group by r),
own as (select r, template, label, n, diagonal, list_distinct(flatten(list_transform(q, lambda x: range(x, x + {NOTICE_K})))) as hit
  from votes join t using (template) where not is_phrase),
spans as (select *, max(len(hit) * {MOST_WORDS} - diagonal) over (partition by r, template order by diagonal / (n * {(MAX_STRETCH - 1) / 2}::double + {DIAGONAL_GAP / 2}::double) range between 1 preceding and 1 following) as span from own),
found as (select r, label, len(list_distinct(flatten(list(hit)))) / n as cover from spans group by r, template, label, n, span),
extra as (select r, list(distinct label) as more, max(cover) as cover from found where cover >= {MIN_COVER} group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base, cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
  coalesce(array_to_string(list_sort(base), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') as labels,
  case when base is not null then 1.0::double else coalesce(cover, 0)::double end as score
from d left join base using (r) left join extra using (r)
"""
