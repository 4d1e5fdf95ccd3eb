"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
run() writes each stage's result as Parquet to the shared folder and rereads it as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kvflow.llm import decontaminate, jaccard, langid, mixing, sharding
from kvflow.llm.common import ROW_KEY, discard, materialise, only_result, table, with_row_key

#: Languages the corpus is for; None takes every language that training rows name.
LANGUAGES: tuple[str, ...] | None = None
#: Documents less like their nearest language's profile than this are rejected, whatever that language's own floor.
LEAST_SCORE = 0.05
#: A language's floor: this share of the score that all but FLOOR_BELOW of its labelled documents reach.
FLOOR_SHARE, FLOOR_BELOW = 0.65, 0.05
#: One whole use of a document, in the sums that the mixing stage rounds.
RATIO_UNIT = 1 << 32


def floors(learnt: DataFrame, profiles: langid.Profiles) -> DataFrame:
    """floor_lang, floor: the least score of each language, from the labelled documents that it is found in."""
    scored = langid.predict(learnt.where("text is not null and lang is not null"), profiles, ["lang"]).where("lang_pred = lang")
    low = F.percentile_approx("score", FLOOR_BELOW, 10_000)
    return scored.groupBy(F.col("lang_pred").alias("floor_lang")).agg(F.greatest(F.lit(LEAST_SCORE), low * FLOOR_SHARE).alias("floor"))


def _whole(docs: DataFrame) -> DataFrame:
    """doc (all columns of docs, out of the way of other names), doc_id, text and the row key."""
    return with_row_key(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["doc_id"], docs["text"].cast("string").alias("text")))


def _content() -> Column:
    """A number for all of doc's columns, nulls and their places included (maps left out)."""
    return F.xxhash64("text", F.to_json(F.col("doc").dropFields("text")))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents of a language of LANGUAGES; undetermined ones and those below their language's floor go.

    Profiles and floors come from the labelled rows of the folds that op1 learns from.  Null, empty and letterless texts
    go; a null doc_id or lang is no reason to; repeated rows fare alike; without labelled rows all go.  Columns may have
    any names.
    """
    learnt = docs.where(langid.fold(F.col("doc_id")) != 1)
    profiles = langid.fit(learnt)
    low = materialise(floors(learnt, profiles), "floors")
    names = [f"d{i}" for i in range(len(docs.columns))]
    judged = langid.predict(docs.toDF(*names), profiles, names, names[docs.columns.index("text")])
    judged = judged.where(F.col("lang_pred") != langid.UNDETERMINED).join(F.broadcast(low), F.col("lang_pred") == F.col("floor_lang"), "left")
    kept = judged.where(F.col("score") >= F.coalesce("floor", F.lit(LEAST_SCORE)))
    if LANGUAGES is not None:
        kept = kept.where(F.col("lang_pred").isin(list(LANGUAGES)))
    return kept.select(*names).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of texts linked by 5-word shingles of similarity 0.8 or more: the one with the smallest
    doc_id, a null one only where the group has no other; then the least by a hash of the text, then of all columns.

    Null, empty and wordless texts are one group.  Rows of one doc_id whose texts lie in different groups all have their
    say.  Of rows repeated in full one stays.  Columns may have any names.
    """
    groups = materialise(jaccard.groups(docs.select("doc_id", "text")), "near")
    key = F.struct(*ROW_KEY)
    best = materialise(groups.groupBy("component").agg(F.min(key).alias("best"), F.max(key).alias("most")), "best")
    # What goes grows with the documents: one plan at every size.
    go = groups.join(best.where("best < most").select("component", "best"), "component").where(key != F.col("best"))
    kept = _whole(docs).join(materialise(go.select(*ROW_KEY).distinct(), "near-go").hint("merge"), ROW_KEY, "left_anti")
    # Rows of one doc_id and text: almost never any, so the texts are dealt by their key only where there are.
    if groups.groupBy(*ROW_KEY).count().where("count > 1").limit(1).count():
        order = Window.partitionBy(*ROW_KEY).orderBy(_content())
        kept = kept.withColumn("place", F.row_number().over(order)).where("place = 1")
    return kept.select("doc.*")


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark window.  Null and wordless texts hold none; repeated rows fare alike; an empty
    benchmark drops nothing.  Columns may have any names."""
    judged = materialise(decontaminate.flags(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark")), "contaminated")
    return _whole(docs).join(judged, ROW_KEY, "left_anti").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document 0, 1 or 2 times so that each source gives the words of its target, to within its longest document.

    taken / size is rounded systematically: on its running sum over a source's documents by size, largest first, so the
    errors of neighbours, which are of about one size, cancel.

    A null source is a source; null ids are documents like any other; null, empty and wordless texts have no words to
    give and go.  Rows repeated in full get copies as so many documents.  Columns may have any names.
    """
    keyed = _whole(docs).select("doc", "text", F.col("doc.source").alias("source"), F.struct(*ROW_KEY, _content().alias("content")).alias("mix_key"))
    taken = materialise(mixing.Mix(keyed, "mix_key").taken(), "taken")
    mixed = taken.where("taken > 0")
    # In whole numbers: sums don't depend on their order.
    ratio = F.floor(F.col("taken").cast("double") / F.col("size") * RATIO_UNIT + 0.5).cast("long")
    part = F.pmod(F.xxhash64("mix_key", F.lit(mixing.SEED)), F.lit(mixing.ORDER_PARTS)).cast("int")
    rated = mixed.select("mix_key", "source", "size", ratio.alias("ratio"), part.alias("part"))
    parts = rated.groupBy("source", "size", "part").agg(F.sum("ratio").alias("n"))
    sizes = parts.groupBy("source", "size").agg(F.sum("n").alias("n"))

    def before(total: str, *by: str, order: list) -> Column:
        rows = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(total).over(rows), F.lit(0).cast("long"))

    sizes = sizes.select(F.col("source").alias("s"), F.col("size").alias("z"), before("n", "source", order=[F.desc("size")]).alias("base"))
    parts = parts.withColumn("start", before("n", "source", "size", order=["part"]))
    starts = parts.join(sizes, parts["source"].eqNullSafe(F.col("s")) & (parts["size"] == F.col("z")))
    starts = starts.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("b"), (F.col("base") + F.col("start")).alias("start"))
    run = rated.withColumn("within", before("ratio", "source", "size", "part", order=["mix_key"]))
    run = run.join(starts, run["source"].eqNullSafe(F.col("s")) & (run["size"] == F.col("z")) & (run["part"] == F.col("b")))
    at = F.col("start") + F.col("within") + RATIO_UNIT // 2
    whole = [F.shiftright(x, RATIO_UNIT.bit_length() - 1) for x in (at, at + F.col("ratio"))]
    planned = run.select("mix_key", (whole[1] - whole[0]).cast("int").alias("times"))
    # Rows repeated in full stand beside one another in the running sum: the copies of all of them go to one.
    planned = planned.groupBy("mix_key").agg(F.sum("times").cast("int").alias("times")).where("times > 0")
    once = keyed.select("doc", "mix_key")
    if taken.groupBy("mix_key").count().where("count > 1").limit(1).count():
        once = once.dropDuplicates(["mix_key"])
    met = once.join(planned, "mix_key")
    return met.select("doc", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).select("doc.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """documents' columns with shard, slot, size, text_crc32 and law.  Null, empty and repeated rows as in sharding.assign;
    a column of docs that has one of these names goes out with ``_in`` after it."""
    own = ["size", "text_crc32", "law", "shard", "slot"]
    found = sharding.assign(docs.withColumn("shard_doc", F.struct(*[docs[c] for c in docs.columns])), carry=("shard_doc",))
    names, known = [], {c.lower() for c in docs.columns} | set(own)
    for name in docs.columns:
        if name.lower() in own:
            while name.lower() in known:
                name += "_in"
            known.add(name.lower())
        names.append(name)
    columns = [F.col("shard_doc")[c].alias(n) for c, n in zip(docs.columns, names, strict=True)]
    return found.select(*columns, *own)


STAGES = [
    ("language", identify_language),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two copies of the corpus at most stand in the shared folder at a time; what a stage wrote on its way goes with it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with only_result(spark) as kept:
            docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
            kept.append(docs)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None
