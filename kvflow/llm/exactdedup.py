"""Exact deduplication by content-defined chunk recipes.  DataFrame functions only.

The normalised text (A-Z lower-cased, null as empty) is cut after white space that follows certain letter pairs, so an
insertion moves only the cuts near it.  Each chunk has a 64-bit identifier, verified corpus-wide against the chunk's
SHA-256: an identifier that stands for two contents is replaced by the SHA-256 wherever it occurs.  A text is then the
ordered list of its chunks' identifiers, and equal lists are equal texts.  Texts are read once and never shuffled; what
moves is some fifty bytes for each chunk of a thousand or more characters.

Defined results: of equal texts the row with the largest doc_id stays; rows that repeat one doc_id and text count
each in group_size and share the flag; a null doc_id stays only where no row of its group has one.  Any text length
works: a stretch without a cut ends at MAX_CHUNK characters.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvflow.llm.common import lower_ascii, materialise

MIN_CHUNK, MAX_CHUNK = 1024, 8192
#: A cut stands after such a pair and one white space.
CUT = r"(?<=[aeiou][nrsd]\s)"
CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?{CUT}|.{{1,{MAX_CHUNK}}}"
#: Identifiers found to stand for several contents that fit in the plan; beyond it every chunk goes by its SHA-256.
MAX_CLASHES = 10_000


def chunks(text: Column) -> Column:
    """The chunks of a text in order; joined they are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), 0)


def short_id(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def _clashing(rows: DataFrame, most: int) -> list[int] | None:
    """Short identifiers that stand for more than one content; None if there are more than most."""
    each = rows.select(F.explode("chunks").alias("c")).select("c.short", "c.content")
    many = each.groupBy("short").agg(F.min("content").alias("least"), F.max("content").alias("greatest")).where("least <> greatest")
    found = [r.short for r in many.select("short").limit(most + 1).collect()]
    return None if len(found) > most else found


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", identify=short_id, max_clashes: int = MAX_CLASHES
) -> DataFrame:
    """id_col, keep_id, group_size, kept, text_sha256, n_chunks: a row for each row of docs."""
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    described = F.transform(chunks(F.col("norm")), lambda c: F.struct(identify(c).alias("short"), F.unhex(F.sha2(c, 256)).alias("content")))
    rows = docs.select(id_col, text.alias("norm")).select(id_col, F.unhex(F.sha2("norm", 256)).alias("digest"), described.alias("chunks"))
    rows = materialise(rows, "recipes")
    clashing = _clashing(rows, max_clashes)
    if clashing is None:
        verified = F.transform("chunks", lambda c: F.hex(c["content"]))
    elif clashing:
        known = F.array(*[F.lit(x).cast("long") for x in clashing])
        verified = F.transform("chunks", lambda c: F.when(F.array_contains(known, c["short"]), F.hex(c["content"])).otherwise(F.hex(c["short"])))
    else:
        verified = F.transform("chunks", lambda c: F.hex(c["short"]))
    listed = rows.select(id_col, "digest", F.size("chunks").alias("n_chunks"), F.concat_ws(",", verified).alias("recipe"))
    groups = listed.groupBy("recipe").agg(F.max(id_col).alias("keep_id"), F.count("*").alias("group_size"))
    # Written, so that the join deals both sides anew and a hot recipe's rows can be split over tasks.
    groups = materialise(groups, "recipe-groups")
    return listed.join(groups, "recipe").select(
        id_col,
        "keep_id",
        "group_size",
        F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "n_chunks",
    )


ORACLE_SQL = """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm from documents
), g as (select norm, max(doc_id) as keep_id, count(*) as group_size from d group by norm)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.norm) as text_sha256
from d join g using (norm)
"""
