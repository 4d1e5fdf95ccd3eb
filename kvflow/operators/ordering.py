"""Operators that follow the order (source_id, seq) of a log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: seq values that one task fills forward; a source of any length is cut into stretches of this many.
STRETCH = 1 << 20


def absorb_select(raw: DataFrame, seed: int = 0, stretch: int = STRETCH) -> DataFrame:
    """Each row's db_id by the last SELECT before it in its source, seed before the first; SELECT rows go.

    Two levels, so that no task holds a whole source: the last SELECT of each stretch is carried to the stretches after
    it over a table of one row a stretch, and rows are filled forward inside their stretch only.
    """
    is_select = F.coalesce((F.upper(F.get("argv", 0).cast("string")) == "SELECT") & (F.size("argv") == 2), F.lit(False))
    chosen = F.when(is_select, F.get("argv", 1).cast("string").try_cast("int"))
    at = F.floor(F.col("seq") / stretch).cast("long")
    marked = raw.withColumns({"is_select": is_select, "chosen": chosen, "stretch": at})
    ends = marked.groupBy("source_id", "stretch").agg(F.max_by("chosen", F.when(F.col("chosen").isNotNull(), F.col("seq"))).alias("end"))
    before = Window.partitionBy("source_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("source_id", "stretch", F.last("end", ignorenulls=True).over(before).alias("carried"))
    inside = Window.partitionBy("source_id", "stretch").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = marked.withColumn("chosen", F.last("chosen", ignorenulls=True).over(inside)).join(carried, ["source_id", "stretch"])
    filled = filled.withColumn("db_id", F.coalesce("chosen", "carried", F.lit(seed)))
    return filled.where("not is_select").select(raw.columns)


def cut_after(rows: DataFrame, until: int, stamp: str = "ts") -> DataFrame:
    """The part of each source before the first row whose time stamp is later than until; 0 keeps everything.

    Rows without a stamp belong to the stamp before them.  Only the first late row of each source is found, by
    aggregation, so logs are neither sorted nor gathered.
    """
    if not until:
        return rows
    late = rows.where(F.col(stamp) > until).groupBy("source_id").agg(F.min("seq").alias("cut_seq"))
    return rows.join(late, "source_id", "left").where(F.col("cut_seq").isNull() | (F.col("seq") < F.col("cut_seq"))).drop("cut_seq")


def order_faults(files: DataFrame) -> DataFrame:
    """file_seq values that don't rise within their source."""
    w = Window.partitionBy("source_id").orderBy("ordinal")
    return files.withColumn("before", F.lag("file_seq").over(w)).where("file_seq <= before").drop("before")
