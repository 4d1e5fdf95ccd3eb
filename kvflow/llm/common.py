"""Pieces that several operators share: text expressions, row keys, materialised tables."""

from __future__ import annotations

import string
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of ASCII white space, and of anything ASCII that is no letter or digit (Java regex).
SPACE = r"[\x20\x09-\x0D]+"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII texts take the fast built-in; translate() does the others."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column, separators: str) -> Column:
    """Non-empty pieces between runs of separators; null gives no words."""
    parts = F.split(F.coalesce(text, F.lit("")), separators)
    return F.filter(parts, lambda w: w != "")


def with_row_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add rk_null, rk_id, rk_text: a null-safe key.  Rows repeated in full share it; others don't."""
    return df.withColumns(
        {
            "rk_null": F.col(id_col).isNull(),
            "rk_id": F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")),
            "rk_text": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.col(text_col).isNull()),
        }
    )


ROW_KEY = ["rk_null", "rk_id", "rk_text"]


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.  Set here only where unset, and then only in local mode."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="kvflow-checkpoint-")
        sc.setCheckpointDir(found)
    return found


#: Paths written inside the open scope, if there is one.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage is cut, and a lost executor costs only a reread."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kvflow/{name}-{uuid.uuid4().hex}"
    if (written := _written.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.__dict__["written_at"] = path
    return found


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(df: DataFrame) -> None:
    """Remove the files of a table that materialise() returned; nothing that is still to be read may depend on them."""
    _delete(df.sparkSession, df.__dict__["written_at"])


@contextmanager
def only_result(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables that are written inside go at its end, but for those that are put into the list given."""
    kept: list[DataFrame] = []
    token = _written.set([])
    try:
        yield kept
    finally:
        written = _written.get()
        _written.reset(token)
        for path in set(written) - {k.__dict__["written_at"] for k in kept}:
            _delete(spark, path)
