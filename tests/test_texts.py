import re

import pytest
from pyspark.sql import functions as F

from tablekeeper.functions import labels as L
from tablekeeper.functions import profile as P
from tablekeeper.functions import rewrite as W


def one(spark, fn, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in sorted(df.select("i", fn(F.col("t")).alias("x")).collect())]


def ruled(spark, kind, *texts, rules=W.NORMALIZE_RULES):
    df = spark.createDataFrame([(i, kind, t) for i, t in enumerate(texts)], "i int, k string, t string")
    return [r.t for r in sorted(W.apply_rules(df, "t", "k", rules).collect(), key=lambda r: r.i)]


def test_strip_noise(spark):
    got = one(
        spark, P.strip_noise, "a /* b\n -- c */ d -- e 'f'\n'g''h' i", "'open -- x", "/* open", "x''y", "'/*' a '*/'",
        "/**/x/***/y/* * / */z", "'" + "a" * 200_000 + "'", "'" + "''" * 50_000 + "'", "/*" + "*" * 50_000 + "/ k",
    )
    assert got == [
        "a   d  \n'' i", "'open  ", "/* open", "x''y", "''", " x y z", "''", "''", "  k"]


def test_strip_noise_random(spark):
    import random
    rng = random.Random(1)
    texts = ["".join(rng.choice(["/*", "*/", "*", "/", "--", "'", "\n", "a "]) for _ in range(30)) for _ in range(300)]

    def plain(t):
        t = re.sub(r"/\*.*?\*/", " ", t, flags=re.S)
        t = re.sub(r"--.*", " ", t)
        return re.sub(r"'[^']*'(?:'[^']*')*", "''", t)

    assert one(spark, P.strip_noise, *texts) == [plain(t) for t in texts]


SIGNAL_TEXTS = {
    "has_cursor": ("declare c\nINSENSITIVE Cursor for", "DECLARE c; CURSOR"), "has_while": ("While(1=1)", "erwhile"),
    "has_temp_table": ("x #tmp", "# x"), "has_table_var": ("declare @t  table(", "declare @t int"),
    "has_dynamic_sql": ("exec (sp_x)", "EXEC(@x)"), "has_merge": ("merge into", "merged"),
    "has_try_catch": ("begin\ntry", "begin trying"), "has_transaction": ("rollback", "BEGIN TRANSACTION"),
    "has_pivot": ("unpivot (", "pivots"), "has_identity": ("identity (1,1)", "identity"),
    "has_temporal": ("period for system_time", "period for system"), "has_output_param": ("@x decimal(1, 2) out", "@x int output2"),
    "has_cte": ("with x as (", "with x as y"),
}


def test_signals(spark):
    assert set(SIGNAL_TEXTS) == set(P.SIGNALS) == set(P.NEEDLES)
    rows = [(k, hit, t) for k, pair in SIGNAL_TEXTS.items() for hit, t in zip((True, False), pair)]
    df = P.signal_flags(spark.createDataFrame(rows, "k string, hit boolean, t string"), "t")
    for r in df.collect():
        assert r[f"sig_{r.k}"] == r.hit, (r.k, r.t)
    # needles change nothing, not even for letters that only match by case folding
    odd = spark.createDataFrame([("DECLARE c CURſOR",), ("IDENTİTY (",), ("wHİLE",), ("#é1",), ("éWHILE",)], "t string")
    with_, without = (P.signal_flags(odd, "t", needles=n).collect() for n in (P.NEEDLES, {}))
    assert with_ == without
    assert with_[0].sig_has_cursor and with_[3].sig_has_temp_table and not with_[4].sig_has_while


def test_wide_signals(spark):
    df = spark.createDataFrame([("EXEC(@x)",), ("BEGIN TRANSACTION",)], "t string")
    rows = P.signal_flags(df, "t", P.SIGNALS_WIDE).collect()
    assert rows[0].sig_has_dynamic_sql and rows[1].sig_has_transaction


@pytest.mark.parametrize("loc,extra,want", [(150, "", "simple"), (151, "", "medium"), (600, "", "medium"), (601, "", "complex"),
                                            (100, "WHILE", "medium"), (99, "WHILE", "simple"), (1, "EXEC (x #t MERGE ", "complex")])
def test_tiers(spark, loc, extra, want):
    text = extra + "\n" * (loc - 1)
    r = P.profile_text(spark.createDataFrame([("VIEW", text)], "k string, t string"), "t", "k").first()
    assert (r.loc, r.complexity_tier) == (loc, want)


def test_forms(spark):
    rows = [("TABLE", "EXEC (x"), ("VIEW", "EXEC (x"), ("FUNCTION", "EXEC (x"), ("FUNCTION", "a"), ("PROCEDURE", "#t"),
            ("PROCEDURE", "#t WHILE"), ("OTHER", "x")]
    df = P.profile_text(spark.createDataFrame(rows, "k string, t string"), "t", "k")
    assert [r.target_form for r in df.collect()] == [
        "sql_ddl", "sql_view", "pyspark", "sql_function", "sql_scripting", "pyspark", "sql_scripting"]


def test_clean_output(spark):
    assert one(
        spark, W.clean_output, "```sql\nSELECT 1\n```", "Here it is:\n\n  create view v\nThen", "no code\nat all", None, "",
        "```\nno code\n```  ", " \n-- x\ny ", "Text\n\n\n   \n\tdef f():\n  pass\n",
    ) == ["SELECT 1", "create view v\nThen", "no code\nat all", None, "", "no code", "-- x\ny", "def f():\n  pass"]


def test_truncation(spark):
    assert one(
        spark, W.looks_truncated, "a;", "a END", "a end \n", "a\n-- x;", "a;\n-- x\n\n  -- y", "TREND", "", None, "  \n", "-- only;", "a; b"
    ) == [False, False, False, True, False, True, True, True, True, True, True]


def test_namespaces(spark):
    def fn(c):
        return W.rewrite_namespace(c, "main", "tmp", "p$__")

    got = one(spark, fn, "main.dbo.t `main`.`a b`.x main . ` c ` . y", "other.dbo.t", "main.dbo", None)
    assert got == ["tmp.`p$__dbo`.t tmp.`p$__a b`.x tmp.`p$__c`. y", "other.dbo.t", "main.dbo", None]
    again = one(spark, fn, *[g for g in got if g])
    assert again == [g for g in got if g]
    assert one(spark, lambda c: W.strip_prefix(c, "p$__"), "p$__p$__dbo p$__x p$_") == ["dbo x p$_"]


def test_table_rules(spark):
    got = ruled(
        spark, "TABLE",
        "CREATE TABLE t (a int  GENERATED ALWAYS AS IDENTITY not  null, b STRING NULL, UNIQUE (a) not enforced,\n)",
        "CREATE TABLE t (a INT DEFAULT null, b INT null) using delta", "CREATE TABLE t (a INT DEFAULT 1);  ",
        "CREATE TABLE t (`a b` INT) USING DELTA;", "CREATE TABLE t (`a b` INT DEFAULT 1) USING DELTA", "CREATE TABLE t (`a,b` INT) ;",
        "CREATE TABLE t (a BIGINT GENERATED BY DEFAULT AS IDENTITY) USING DELTA", None, "",
    )
    d, m = W.DEFAULTS_PROPERTY, W.MAPPING_PROPERTIES
    assert got == [
        "CREATE TABLE t (a BIGINT  GENERATED ALWAYS AS IDENTITY NOT NULL, b STRING\n)",
        f"CREATE TABLE t (a INT DEFAULT NULL, b INT) using delta TBLPROPERTIES ({d})",
        f"CREATE TABLE t (a INT DEFAULT 1) TBLPROPERTIES ({d});",
        f"CREATE TABLE t (`a b` INT) USING DELTA TBLPROPERTIES ({m});",
        f"CREATE TABLE t (`a b` INT DEFAULT 1) USING DELTA TBLPROPERTIES ({m},{d})",
        f"CREATE TABLE t (`a,b` INT)  TBLPROPERTIES ({m});",
        "CREATE TABLE t (a BIGINT GENERATED BY DEFAULT AS IDENTITY) USING DELTA", None, "",
    ]
    assert ruled(spark, "TABLE", *got) == got


def test_schema_and_procedure_rules(spark):
    assert ruled(spark, "SCHEMA", "create schema s", "CREATE SCHEMA IF NOT EXISTS s") == [
        "CREATE SCHEMA IF NOT EXISTS s"] * 2
    assert ruled(spark, "PROCEDURE", "p language sql as begin begin end", "p as begin begin end", "p sql security definer begin") == [
        "p language sql SQL SECURITY INVOKER as begin begin end", "p as SQL SECURITY INVOKER\nBEGIN begin end",
        "p sql security definer begin"]
    assert ruled(spark, "VIEW", "create schema s NULL,") == ["create schema s NULL,"]


def test_leak_and_kind(spark):
    got = one(spark, W.leak_check, "SELECT [a", "-- [a\n/* [b */ [1]", None)
    assert [tuple(g) for g in got] == [(None, W.LEAK_REASON), ("-- [a\n/* [b */ [1]", None), (None, None)]
    assert one(spark, W.is_python, "create or replace function f", "def run()", None, "CREATE VIEW v") == [False, True, True, True]


def test_labels(spark):
    def both(c):
        return F.concat_ws("|", L.classify_text(c, status=F.lit("fail")), L.classify_text(c, L.CHART_CLASSES, status=F.lit("timeout"), timeout_label="late"))

    assert one(spark, both, "ONLY_AT_BEGINNING MATCHED", "PARSE SYNTAX ERROR", "Missing", None, "x end of input") == [
        "declare_placement|late", "parse_other|parse syntax", "other|late", "other|late", "unclosed_block|late"]
    assert one(spark, lambda c: L.excerpt(c, 4), "a\nbcdef", None) == ["a bc", None]
    assert one(spark, L.status_label, "pass", "sound_dep", "timeout", "x") == ["1 pass", "2 sound (dep)", "3 timeout", "4 fail"]
    assert one(spark, L.is_success, "pass", "fail") == [True, False]


def test_template(spark):
    def fn(c):
        return L.render_template(c, {"a": F.lit("{b}"), "b": F.lit("x$1\\"), "n": F.lit(None)})

    assert one(spark, fn, "{a}-{b}-{n}-{c}{", None, "plain") == ["{b}-x$1\\--{c}{", None, "plain"]
