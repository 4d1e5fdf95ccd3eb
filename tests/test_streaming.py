"""Streaming operators over file streams, and the listener."""

from datetime import datetime, timedelta

from kvflow.streaming.dedup import distinct_keys, windowed_counts
from kvflow.streaming.status import Listener, Status

T0 = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, db_id int, key string, cmd_name string"


def run(spark, tmp_path, name, batches, make):
    """Feed batches one file after another; rows of the memory table in the end."""
    folder = tmp_path / name
    folder.mkdir()
    query = make(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))).writeStream.format("memory").queryName(name).outputMode("append").start()
    try:
        for i, rows in enumerate(batches):
            data = [(T0 + timedelta(minutes=m), db, k, c) for m, db, k, c in rows]
            spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("overwrite").json(str(tmp_path / f"{name}-{i}"))
            part = next(p for p in (tmp_path / f"{name}-{i}").iterdir() if p.name.startswith("part-") and p.suffix == ".json")
            part.rename(folder / f"{i}.json")
            query.processAllAvailable()
        return spark.table(name).collect()
    finally:
        query.stop()


def test_windows_drop_late_rows(spark, tmp_path):
    listener = Listener(status := Status())
    spark.streams.addListener(listener)
    try:
        batches = [[(0, 0, "a", "SET"), (1, 0, "b", "SET"), (6, 0, "c", "DEL")], [(30, 0, "d", "SET")], [(2, 0, "late", "SET"), (60, 0, "e", "SET")]]
        got = run(spark, tmp_path, "windows", batches, windowed_counts)
    finally:
        spark.streams.removeListener(listener)
    assert sorted((r.start.minute, r.cmd_name, r.n) for r in got) == [(0, "SET", 2), (5, "DEL", 1), (30, "SET", 1)]
    assert status.progress.get("name") == "windows"


def test_sliding_windows(spark, tmp_path):
    got = run(spark, tmp_path, "sliding", [[(7, 0, "a", "SET")], [(90, 0, "z", "SET")], [(91, 0, "z", "SET")]], lambda df: windowed_counts(df, window="10 minutes", slide="5 minutes"))
    assert sorted((r.start.minute, r.n) for r in got) == [(0, 1), (5, 1)]


def test_distinct_keys(spark, tmp_path):
    got = run(spark, tmp_path, "distinct", [[(0, 0, "a", "SET"), (0, 0, "a", "DEL")], [(1, 0, "a", "SET"), (1, 1, "a", "SET")]], distinct_keys)
    assert sorted((r.db_id, r.key) for r in got) == [(0, "a"), (1, "a")]
