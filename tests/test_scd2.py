from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablekeeper.operators.scd2 import (
    OPEN_END, open_history, scd2_apply, scd2_backfill, scd2_changes, scd2_columns, scd2_schema,
)
from tablekeeper.sources.history import HistoryTable
from tablekeeper.sources.tables import versions

KEY, TRACK = ["k"], ["v", "w"]
SCHEMA = "k string, v int, w string, ETL_load int"


def src(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def first(spark):
    rows = [("same", 1, "a", 1), ("changed", 1, "a", 1), ("gone", 1, "a", 1), ("to_null", 1, "a", 1),
            ("from_null", None, "a", 1), (None, 5, "n", 1), ("audit", 1, "a", 1)]
    return open_history(src(spark, rows), "2024-01-01")


def second(spark):
    return src(spark, [("same", 1, "a", 1), ("changed", 2, "a", 1), ("to_null", None, "a", 1),
                       ("from_null", 1, "a", 1), (None, 5, "n", 1), ("audit", 1, "a", 2), ("new", 1, "z", 2)])


def by_key(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.k, []).append(r)
    return {k: sorted(v, key=lambda r: r.valid_from) for k, v in out.items()}


def test_apply_edges(spark):
    got = by_key(scd2_apply(first(spark), second(spark), KEY, TRACK, "2024-02-01"))
    assert {k: len(v) for k, v in got.items()} == {
        "same": 1, "changed": 2, "gone": 1, "to_null": 2, "from_null": 2, None: 1, "audit": 1, "new": 1}
    old, new = got["changed"]
    assert (old.IsCurrent, new.IsCurrent) == (False, True)
    assert old.valid_to == new.valid_from == datetime(2024, 2, 1)
    assert str(new.valid_to)[:23] == OPEN_END
    assert got["audit"][0].ETL_load == 1 and got["gone"][0].IsCurrent


def test_apply_twice_is_once(spark):
    once = scd2_apply(first(spark), second(spark), KEY, TRACK, "2024-02-01")
    twice = scd2_apply(once, second(spark), KEY, TRACK, "2024-03-01")
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_windows_are_contiguous(spark):
    h = first(spark)
    for month in range(2, 6):
        h = scd2_apply(h, src(spark, [("changed", month, "a", 1), ("same", 1, "a", 1)]), KEY, TRACK, f"2024-0{month}-01")
    versions_of = by_key(h)["changed"]
    assert len(versions_of) == 5 and sum(r.IsCurrent for r in versions_of) == 1
    assert all(a.valid_to == b.valid_from for a, b in zip(versions_of, versions_of[1:]))


def test_deletes_close(spark):
    got = by_key(scd2_apply(first(spark), second(spark), KEY, TRACK, "2024-02-01", deletes="close"))
    assert not got["gone"][0].IsCurrent and got["gone"][0].valid_to == datetime(2024, 2, 1)
    with pytest.raises(ValueError):
        scd2_apply(first(spark), second(spark), KEY, TRACK, "2024-02-01", deletes="drop")


def test_duplicate_source_key_is_refused(spark):
    with pytest.raises(ValueError, match="occurs 2 times"):
        scd2_apply(first(spark), src(spark, [("a", 1, "", 1), ("a", 2, "", 1)]), KEY, TRACK, "2024-02-01")


def test_backward_time_is_refused(spark):
    bad = scd2_apply(first(spark), second(spark), KEY, TRACK, "2023-02-01")
    with pytest.raises(Exception, match="before the start"):
        bad.collect()


def test_identity_column_is_null_in_new_rows(spark):
    dim = first(spark).withColumn("sk", F.lit(7).cast("long"))
    got = by_key(scd2_apply(dim, second(spark), KEY, TRACK, "2024-02-01"))
    assert got["new"][0].sk is None and got["same"][0].sk == 7


def test_backfill_flags_open_rows(spark):
    done = scd2_apply(first(spark), second(spark), KEY, TRACK, "2024-02-01")
    folded = scd2_backfill(done.where("IsCurrent").drop("IsCurrent"), done.where("not IsCurrent").drop("IsCurrent"))
    assert sorted(map(str, folded.collect())) == sorted(map(str, done.collect()))


def test_changes(spark):
    before = first(spark)
    after = scd2_apply(before, second(spark), KEY, TRACK, "2024-02-01")
    kinds = scd2_changes(before, after, KEY).groupBy("_change_type").count().collect()
    assert {r[0]: r[1] for r in kinds} == {"insert": 4, "update_preimage": 3, "update_postimage": 3}
    undone = scd2_changes(after, before, KEY).where("_change_type = 'delete'")
    assert undone.count() == 4


def test_columns_and_schema():
    meta = [
        {"name": "id", "type": "bigint", "identity": True, "not_null": True}, {"name": "code", "type": "string", "not_null": True},
        {"name": "price", "type": "decimal(19,4)"}, {"name": "etl_run", "type": "int"},
        {"name": "s", "type": "timestamp", "row_start": True}, {"name": "e", "type": "timestamp", "row_end": True},
    ]
    roles = scd2_columns(meta, ["code"])
    assert roles["business"] == ["code", "price", "etl_run"] and roles["track"] == ["price"]
    assert roles["insert"] == ["code", "price", "etl_run", "s", "e", "IsCurrent"]
    schema = scd2_schema(meta)
    assert schema.simpleString() == (
        "struct<id:bigint,code:string,price:decimal(19,4),etl_run:int,s:timestamp,e:timestamp,IsCurrent:boolean>")
    assert not schema["s"].nullable and not schema["code"].nullable and schema["price"].nullable


def test_stored_history(spark, tmp_path):
    path = str(tmp_path / "h")
    table = HistoryTable(spark, path, KEY, TRACK)
    table.load(first(spark).drop("valid_from", "valid_to", "IsCurrent"), "2024-01-01")
    assert table.apply(second(spark), "2024-02-01") == 2
    want = scd2_apply(first(spark), second(spark), KEY, TRACK, "2024-02-01")
    assert sorted(map(str, table.read().select(want.columns).collect())) == sorted(map(str, want.collect()))
    # a step that never committed is not seen, and the next step takes its place
    first(spark).write.partitionBy("IsCurrent").parquet(f"{path}/tk_version=3")
    (tmp_path / "h" / "tk_version=3" / "_SUCCESS").unlink()
    assert versions(spark, path) == [1, 2]
    assert table.read().count() == want.count()
    assert table.apply(second(spark), "2024-03-01") == 3
    assert table.read().count() == want.count()
    with pytest.raises(ValueError):
        table.load(second(spark), "2024-01-01")
