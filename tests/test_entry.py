"""The registry, and a sample of queries against their oracles on the smallest tables."""

import os

import pytest

import __spark_entry__
from kvflow.plans import catalogue

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


def test_registry():
    known = __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(known)
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL) <= set(known)


@needs_data
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", ["entries_parse", "filter_all", "slot_route", "replay_list", "rdb_roundtrip", "db_forward_fill", "parse_filter_route", "replay_expiry", "replay_conditional", "replay_zadd_flags", "manifest_cut", "keys_keynum", "keys_keyword", "decode_listpack", "decode_stream"])
def test_against_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    want = c.sql(catalogue.ORACLE_SQL[name])
    columns = sorted(want.columns)
    got = catalogue.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    rows = lambda r: sorted(tuple(map(str, x)) for x in r)
    assert rows(got.select(columns).collect()) == rows(want.select(*columns).fetchall())


def test_manifest_cut_by_pieces(spark, tmp_path, monkeypatch):
    """No row holds more of a log than a piece, however long the log; ids leave gaps, and the last piece is short."""
    duckdb = pytest.importorskip("duckdb")
    spark.range(20_000).selectExpr("id + case when id > 9000 then 30001 else 0 end as event_id").write.parquet(str(tmp_path / "events.parquet"))
    seen, decode = [], catalogue.aof.decode_parts
    monkeypatch.setattr(catalogue.aof, "decode_parts", lambda files, *a: (seen.append(files), decode(files, *a))[1])
    got = catalogue.manifest_cut(spark, str(tmp_path)).selectExpr("seq", "db_id", "line").collect()
    assert seen[0].selectExpr("max(octet_length(content))").first()[0] < 150_000
    c = duckdb.connect()
    c.sql(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    want = c.sql(catalogue.ORACLE_SQL["manifest_cut"]).project("seq, db_id, line").fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 6000


def test_plans_stay_narrow(spark):
    """Parsing and filtering make one stage; only needed columns and rows are read."""
    from kvflow.operators.filters import FilterConfig, apply_filters
    from kvflow.operators.parse import parse

    raw = spark.range(10).selectExpr("'s' as source_id", "id as seq", "0 as db_id", "array(cast('GET' as binary), cast(cast(id as string) as binary)) as argv")
    plan = apply_filters(parse(raw, False), FilterConfig(allow_key_prefix=("1",)))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Python" not in plan
