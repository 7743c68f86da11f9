import codecs
import hashlib

from pyspark.sql import functions as F

from tablekeeper.sources.files import decode_text, ingest_objects, path_metadata, scan_files, stable_id

LONG = "CREATE TABLE é (a INT) -- 20 and more letters\n"
CYRILLIC = "выбор всех строк таблицы " * 4
LATE = "名" * 200 + "SELECT a, b, c FROM t WHERE d = 1 " * 30  # nothing but ideographs in the first bytes
CASES = {
    "utf16be bare": LONG.encode("utf-16-be"), "cyrillic bare": CYRILLIC.encode("utf-16-le"), "late": LATE.encode("utf-16-le"),
    "some controls": b"\x01" * 30 + b"a" * 200,
    "utf16le": codecs.BOM_UTF16_LE + LONG.encode("utf-16-le"),
    "utf16be": codecs.BOM_UTF16_BE + LONG.encode("utf-16-be"),
    "two marks": codecs.BOM_UTF16_LE * 2 + LONG.encode("utf-16-le"),
    "utf8 mark": codecs.BOM_UTF8 + LONG.encode(),
    "utf16le bare": LONG.encode("utf-16-le"),
    "utf8": LONG.encode(),
    "latin1": "caf\xe9 \xff".encode("latin-1"),
    "odd": codecs.BOM_UTF16_LE + "abc".encode("utf-16-le") + b"x",
    "lone high": codecs.BOM_UTF16_LE + b"a\x00" + b"\x00\xd8" + b"b\x00",
    "lone low": codecs.BOM_UTF16_BE + b"\x00a" + b"\xdc\x00" + b"\x00b",
    "high at end": codecs.BOM_UTF16_LE + b"a\x00" + b"\x00\xd8",
    "pair": codecs.BOM_UTF16_LE + "a\U0001f600b".encode("utf-16-le"),
    "pair be": codecs.BOM_UTF16_BE + "a\U0001f600b\U0001f600".encode("utf-16-be"),
    "bad utf8 after mark": codecs.BOM_UTF8 + b"a\xffb",
    "empty": b"",
    "few nuls": b"a\x00b",
}


TEXTS = {
    "utf16le": LONG, "utf16be": LONG, "two marks": LONG, "utf8 mark": LONG, "utf16le bare": LONG, "utf16be bare": LONG, "utf8": LONG,
    "latin1": "caf\xe9 \xff", "odd": "abc\ufffd", "lone high": "a\ufffdb", "lone low": "a\ufffdb", "high at end": "a\ufffd",
    "pair": "a\U0001f600b", "pair be": "a\U0001f600b\U0001f600", "bad utf8 after mark": "a\ufffdb", "empty": "", "few nuls": "a\0b",
    "cyrillic bare": CYRILLIC, "late": LATE, "some controls": "\x01" * 30 + "a" * 200,
}


def test_decode(spark):
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in CASES.items()], "name string, content binary")
    got = {r.name: r.text for r in df.select("name", decode_text(F.col("content")).alias("text")).collect()}
    assert got == TEXTS


def test_path_metadata(spark):
    cases = {
        "/a/VIEW/dbo.V.sql": ("VIEW", "dbo", "V", "dbo.V", "dbo.V.sql"),
        "/a/TABLE/a.b.c.SQL": ("TABLE", "a", "b.c", "a.b.c", "a.b.c.SQL"),
        "/VIEW/x/PROCEDURE/deep/plain.sql": ("PROCEDURE", "dbo", "plain", "dbo.plain", "plain.sql"),
        "/nowhere/t.sql": ("TABLE", "dbo", "t", "dbo.t", "t.sql"),
        "dbfs:/Volumes/FUNCTION/s.f.txt": ("FUNCTION", "s", "f.txt", "s.f.txt", "s.f.txt"),
        "VIEW.sql": ("TABLE", "dbo", "VIEW", "dbo.VIEW", "VIEW.sql"),
        "/VIEW/a..sql": ("VIEW", "a", "", "a.", "a..sql"),
    }
    df = spark.createDataFrame([(p,) for p in cases], "path string")
    got = {r.path: tuple(r.m) for r in df.select("path", path_metadata(F.col("path")).alias("m")).collect()}
    assert got == cases


def test_stable_id(spark):
    got = spark.range(1).select(stable_id(F.lit("VIEW"), F.lit("dbo.é.sql"))).first()[0]
    assert got == hashlib.sha1("VIEW/dbo.é.sql".encode()).hexdigest()[:16]


def test_scan_and_ingest(spark, tmp_path):
    for folder, name, raw in (
        ("VIEW", "dbo.v.sql", CASES["utf16le"]), ("PROCEDURE", "dbo.p.sql", b"DECLARE c CURSOR;\nEXEC (x)\nWHILE 1=1 MERGE t"),
        ("TABLE", "dbo.t.sql", b"/* CURSOR\n\n */ a"), ("TABLE", "note.txt", b"no"),
    ):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(raw)
    rows = {r.source_file: r for r in ingest_objects(scan_files(spark, str(tmp_path))).collect()}
    assert set(rows) == {"dbo.v.sql", "dbo.p.sql", "dbo.t.sql"}
    p, t, v = rows["dbo.p.sql"], rows["dbo.t.sql"], rows["dbo.v.sql"]
    assert (p.loc, p.target_form, p.complexity_tier, p.complexity_score) == (3, "pyspark", "complex", 6.02)
    assert (t.loc, t.target_form, t.complexity_tier, t.sig_has_cursor) == (1, "sql_ddl", "trivial", False)
    assert v.source_sql == LONG and v.source_bytes == len(CASES["utf16le"]) and v.complexity_tier == "simple"
    assert v.object_id == hashlib.sha1(b"VIEW/dbo.v.sql").hexdigest()[:16]
