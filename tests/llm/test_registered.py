"""Registered queries on the smallest provided tables: against their SQL, or what their contracts promise."""

from __future__ import annotations

import duckdb
import pytest

from tablekeeper.llm import queries

SF = "/root/testdata/sf0.001"


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cur = con.execute(queries.ORACLE[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted([tuple(plain(x) for x in row) for row in cur.fetchall()], key=str)
    assert sorted([tuple(plain(r[c]) for c in names) for r in df.collect()], key=str) == want


def test_quality_on_held_out_rows(spark):
    found = {r.doc_id: r for r in queries.QUERIES["op4_quality_classifier"](spark, SF.replace("0.001", "0.01")).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF.replace('0.001', '0.01')}/labels.parquet'").fetchall()
    unseen = [(found[i].predicted, q) for i, q in labels if found[i].held_out]
    assert len(unseen) > 50 and sum(p == q for p, q in unseen) / len(unseen) > 0.95


def test_rows(spark):
    n = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "pages", "conversations")}
    assert queries.QUERIES["op5_substring_dedup"](spark, SF).count() == n["documents"]
    assert queries.QUERIES["op7_html_extraction"](spark, SF).count() == n["pages"]
    assert queries.QUERIES["op8_chat_formatting"](spark, SF).where("action <> 'insert'").count() == n["conversations"]
    licensed = duckdb.sql(f"SELECT count(*) FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM '{SF}/documents.parquet') WHERE l LIKE '%icense%'").fetchall()[0][0]
    assert queries.QUERIES["op2_license_scan"](spark, SF).where("family <> 'unknown'").count() == licensed
