"""Temporal join, history as of a time, change feed and stream: against plain Python, with the files they read."""

import random
from datetime import datetime, timedelta

import pytest

from tablekeeper.operators.temporal import as_of, temporal_join
from tablekeeper.sources.history import HistoryTable
from tablekeeper.streaming.scd2 import batch_writer

FACTS = "row int, k int, j string, at timestamp_ntz, stretch string, salt int, low int"
HISTORY = "k int, j string, valid_from timestamp_ntz, valid_to timestamp_ntz, IsCurrent boolean, end string, f int"


def moment(n):
    return datetime(2024, 1, 1) + timedelta(hours=n)


def plain(facts, history, how):
    out = []
    for f in facts:
        met = [
            h for h in history if None not in (*f[1:4], *h[:3]) and f[1:3] == h[:2] and h[2] <= f[3] and (h[3] is None or f[3] < h[3])
        ]
        out += [(*f, *h[2:]) for h in met] or ([(*f, *[None] * 5)] if how == "left" else [])
    return sorted(map(str, out))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("per_task", [15, 1_000_000])
def test_temporal_join(spark, how, per_task):
    """One key holds most facts, one most versions; windows overlap, end never, or hold nothing."""
    pick = random.Random(7)
    facts = [
        (i, pick.choice([1, 1, 1, 2, 3, None]), pick.choice(["x", "x", None]), pick.choice([moment(pick.randrange(4000)), moment(77), None]), "s", 1, i)
        for i in range(300)
    ]
    facts += facts[:5]
    history = []
    for _ in range(120):
        start = pick.randrange(-500, 4500)
        end = pick.choice([None, moment(start + pick.randrange(-5, 900)), datetime(9999, 12, 31)])
        history.append((pick.choice([1, 2, 2, 2, 4, None]), "x", pick.choice([moment(start)] * 9 + [None]), end, end is None, "e", start))
    history += history[:3]
    joined = temporal_join(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(history, HISTORY), ["k", "j"], "at", how=how, per_task=per_task, buckets=8
    )
    assert joined.columns == ["row", "k", "j", "at", "stretch", "salt", "low", "valid_from", "valid_to", "IsCurrent", "end", "f"]
    assert sorted(str(tuple(r)) for r in joined.collect()) == plain(facts, history, how)


def test_temporal_join_has_no_join_on_the_key_alone(spark):
    facts, history = spark.createDataFrame([], FACTS), spark.createDataFrame([], HISTORY)
    joined = temporal_join(facts, history, ["k"], "at", prefix="h_")
    assert joined.count() == 0 and "h_j" in joined.columns
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and plan.count("stretch") > 2 and plan.count("salt") > 2
    with pytest.raises(ValueError, match="prefix"):
        temporal_join(facts, history, ["k"], "at")
    with pytest.raises(ValueError, match="how"):
        temporal_join(facts, history, ["k", "j"], "at", how="full")


SCHEMA = "id int, name string, tk_note string"


@pytest.fixture
def kept(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "history"), ["id"], ["name"], buckets=4)
    table.load(spark.createDataFrame([(i, f"n{i}", "a") for i in range(40)], SCHEMA), "2024-01-01")
    table.apply(spark.createDataFrame([(3, "new", "b"), (77, "added", "b")], SCHEMA), "2024-02-01")
    table.apply(spark.createDataFrame([(3, "newer", "c")], SCHEMA), "2024-03-01")
    return table


def test_as_of_reads_only_folders_that_can_hold_the_instant(kept):
    for instant, name in (("2024-01-20", "n3"), ("2024-02-01", "new"), ("2024-02-29 23:59:59", "new"), ("2024-03-01", "newer")):
        rows = kept.as_of(instant)
        assert rows.columns == kept.read().columns
        want = sorted(map(tuple, as_of(kept.read(), instant).collect()), key=str)
        assert sorted(map(tuple, rows.collect()), key=str) == want
        assert [r.name for r in rows.where("id = 3").collect()] == [name]
    late = kept.as_of("2024-03-05").inputFiles()
    assert late and not any("IsCurrent=false" in f for f in late)
    early = kept.as_of("2024-01-20").inputFiles()
    assert any("IsCurrent=false" in f and "tk_version=2" in f for f in early) and not any("tk_version=3/IsCurrent=false" in f for f in early)
    assert kept.as_of("1999-01-01").count() == 0


def test_changes_are_read_from_their_versions_only(kept):
    feed = kept.changes(2)
    assert sorted((r.id, r.name, r.tk_change, r.tk_version) for r in feed.collect()) == [(3, "new", "closed", 3), (3, "newer", "opened", 3)]
    assert all("tk_version=3/_changes" in f for f in feed.inputFiles())
    both = sorted((r.id, r.tk_change, r.tk_version) for r in kept.changes(1).collect())
    assert both == [(3, "closed", 2), (3, "closed", 3), (3, "opened", 2), (3, "opened", 3), (77, "opened", 2)]
    kept.drop_stale()
    assert sorted((r.id, r.tk_change, r.tk_version) for r in kept.changes(1).collect()) == both
    assert kept.changes(3).count() == 0 and set(kept.changes(3).columns) == set(feed.columns)
    for after, until in ((0, None), (1, 9)):
        with pytest.raises(ValueError, match="not recorded"):
            kept.changes(after, until)


def test_a_batch_that_runs_twice_adds_nothing(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "streamed"), ["id"], ["name"], buckets=2)
    write = batch_writer(table, "at", "stream")
    rows = [(1, "a", "", "2024-01-01"), (1, "b", "", "2024-02-01"), (2, "z", "", "2024-02-01")]
    batch = spark.createDataFrame(rows, f"{SCHEMA}, at string").selectExpr("id", "name", "tk_note", "cast(at as timestamp_ntz) as at")
    write(batch, 0)
    first = sorted(map(str, table.read().collect()))
    assert len(first) == 3 and len(table.tags()) == 2
    write(batch, 0)
    write(batch.where("false"), 1)
    assert sorted(map(str, table.read().collect())) == first and len(table.tags()) == 2
    with pytest.raises(ValueError, match="NULL"):
        write(batch.selectExpr("id", "name", "tk_note", "cast(NULL as timestamp_ntz) as at"), 2)
