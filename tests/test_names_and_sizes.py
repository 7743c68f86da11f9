"""Helper columns leave the user's alone, copies spread over chunks, and staging needs a shared folder."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tablekeeper.functions import tsql
from tablekeeper.operators.joins import spread_join
from tablekeeper.operators.merge import merge_update
from tablekeeper.operators.scd2 import open_history, scd2_apply, scd2_changes
from tablekeeper.sources.tables import stage_folder

NAMES = ["hit", "hit_", "_hit", "_id", "_gone", "_p", "_k", "_salt", "_name"]


def test_history_keeps_columns_of_any_name(spark):
    def source(rows):
        return spark.createDataFrame([(k, v, *[f"{c} {k}" for c in NAMES]) for k, v in rows], f"k int, v string, {', '.join(f'`{c}` string' for c in NAMES)}")

    before = open_history(source([(1, "a"), (2, "b")]), "2024-01-01")
    after = scd2_apply(before, source([(1, "a"), (2, "c"), (3, "d")]), ["k"], ["v", *NAMES], "2024-02-01")
    rows = after.collect()
    assert sorted((r.k, r.v, r.IsCurrent) for r in rows) == [(1, "a", True), (2, "b", False), (2, "c", True), (3, "d", True)]
    assert all(r[c] == f"{c} {r.k}" for r in rows for c in NAMES)
    changes = scd2_changes(before, after, ["k"]).collect()
    assert changes and all(r[c] == f"{c} {r.k}" for r in changes for c in NAMES)


def test_merge_and_spread_join_keep_columns_of_any_name(spark):
    target = spark.createDataFrame([(1, "a", "t"), (2, "b", "t")], "k int, v string, _hit string")
    source = spark.createDataFrame([(1, "x", "mine")], "k int, hit string, _hit string")
    merged = merge_update(target, source, ["k"], {"v": F.col("s.hit"), "_hit": F.col("s._hit")})
    assert sorted(tuple(r) for r in merged.collect()) == [(1, "x", "mine"), (2, "b", "t")]
    left = spark.createDataFrame([(i, 1, "l") for i in range(20)], "id int, k int, _salt string")
    right = spark.createDataFrame([(1, "r", "s", 7)], "k int, salt string, _salts string, rows int")
    joined = spread_join(left, right, ["k"], salt_by=["id"], per_salt=3).collect()
    assert len(joined) == 20 and {(r["_salt"], r["salt"], r["_salts"], r["rows"]) for r in joined} == {("l", "r", "s", 7)}


def test_equal_parts_spread_over_chunks(spark):
    copies = spark.range(30_000).select(F.lit(1).alias("k"), F.lit(5).alias("o"), F.lit("x").alias("v"))
    chunks = tsql.string_agg_chunks(copies, ["k"], "v", "-", ["o"], rows_per_chunk=1_000)
    sizes = [len(r.v) for r in chunks.collect()]
    assert len(sizes) > 20 and max(sizes) < 6_000 and sum(sizes) + len(sizes) - 1 == 59_999


def test_ranges_do_not_grow_with_the_rows(spark, capsys):
    rows = spark.range(20_000).selectExpr("id % 3 AS k", "hash(id) AS o", "cast(id AS string) AS v")
    chunks = tsql.string_agg_chunks(rows, ["k"], "v", "-", ["o"], rows_per_chunk=50)
    chunks.explain()
    (ranges,) = {int(n) for n in re.findall(r"rangepartitioning\(.*?, (\d+)\)", capsys.readouterr().out)}
    assert ranges <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = sorted(tuple(r) for r in chunks.collect())
    assert max(v.count("-") + 1 for _, _, v in found) == 50 and len({r[:2] for r in found}) == len(found)
    whole = {r.k: r.v for r in tsql.string_agg(rows, ["k"], "v", "-", ["o", "v"]).collect()}
    assert {k: "-".join(v for a, _, v in found if a == k) for k in whole} == whole


def test_a_cluster_needs_a_shared_folder():
    conf = SimpleNamespace(get=lambda name, default=None: default if name == "spark.checkpoint.dir" else "/here")

    def session(master):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))

    assert stage_folder(session("local[2]")) == "/here/_stage"
    with pytest.raises(RuntimeError, match="checkpoint"):
        stage_folder(session("spark://host:7077"))
