"""File corpora: scan, decode, path metadata, stable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.profile import SIGNALS, profile_text

# Folder names that give an object its type, in the order files
# are told apart, and the names used where a path does not say.
OBJECT_FOLDERS = ("SCHEMA", "SYNONYM", "TABLE", "FUNCTION", "VIEW", "PROCEDURE")
DEFAULT_FOLDER = "TABLE"
DEFAULT_SCHEMA = "dbo"

# Bytes that plain text does not hold, but half of UTF-16 text of most alphabets does.
CONTROLS = "".join(chr(c) for c in range(32) if c not in (9, 10, 12, 13))
CONTROL_LIMIT = 20
CONTROL_SHARE = 0.25


def scan_files(spark: SparkSession, path: str, glob: str = "*.sql") -> DataFrame:
    """One row per file below ``path``: path, modificationTime, length, content."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


# On the bytes of UTF-16 text, a character each: a run of well-formed units, then a lone surrogate.
_HIGH, _LOW, _ANY = r"[\xD8-\xDB]", r"[\xDC-\xDF]", r"[\xD8-\xDF]"
_LONE_LE = rf"(?s)\G((?:.[^\xD8-\xDF]|.{_HIGH}.{_LOW})*+).{_ANY}"
_LONE_BE = rf"(?s)\G((?:[^\xD8-\xDF].|{_HIGH}.{_LOW}.)*+){_ANY}."


def _utf16(content: Column, little: bool) -> Column:
    """UTF-16 text; lone surrogates and a lone last byte become the replacement character.

    Texts without lone surrogates, that is nearly all, are decoded as they are.
    """
    size = F.octet_length(content)
    whole = F.substring(content, F.lit(1), (size - size % 2).cast("int"))
    chars = F.decode(whole, "ISO-8859-1")
    lone, mark = (_LONE_LE, "$1\u00fd\u00ff") if little else (_LONE_BE, "$1\u00ff\u00fd")
    name = "UTF-16LE" if little else "UTF-16BE"
    mended = F.decode(F.encode(F.regexp_replace(chars, lone, mark), "ISO-8859-1"), name)
    text = F.when(chars.rlike(lone), mended).otherwise(F.decode(whole, name))
    text = F.concat(text, F.when(size % 2 == 1, F.lit("\ufffd")).otherwise(""))
    return F.ltrim(text, F.lit("\ufeff"))


def _controls(chars: Column) -> Column:
    return F.length(chars) - F.length(F.translate(chars, CONTROLS, ""))


def decode_text(content: Column) -> Column:
    """Text of a file: by byte order mark, else UTF-16 if control bytes abound, else UTF-8, else Latin-1.

    All bytes count: in UTF-16 text of an alphabet every other byte is one of the first few, so more than CONTROL_LIMIT
    control bytes and CONTROL_SHARE of the content mean UTF-16, and their places tell which byte comes first. They are
    counted only where there is one.
    """
    head = F.hex(F.substring(content, F.lit(1), F.lit(3)))
    utf8 = content.cast("string")
    chars = F.decode(content, "ISO-8859-1")
    controls = _controls(chars)
    many = (controls > CONTROL_LIMIT) & (controls >= F.octet_length(content) * CONTROL_SHARE)
    wide = F.when(utf8.rlike(r"[\x00-\x08\x0B\x0E-\x1F]"), many).otherwise(False)
    high_first = _controls(F.regexp_replace(chars, "(?s)(.).?", "$1")) * 2 > controls
    return (
        F.when(head.startswith("FFFE"), _utf16(content, True))
        .when(head.startswith("FEFF"), _utf16(content, False))
        .when(head == "EFBBBF", F.make_valid_utf8(F.substring(content, F.lit(4), F.octet_length(content)).cast("string")))
        .when(wide, F.when(high_first, _utf16(content, False)).otherwise(_utf16(content, True)))
        .when(F.is_valid_utf8(utf8), utf8)
        .otherwise(F.decode(content, "ISO-8859-1"))
    )


def path_metadata(path: Column) -> Column:
    """Struct of type folder, file, schema, object and full name read off a path."""
    parts = F.split(F.translate(path, ":", "/"), "/")
    folders = F.filter(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: p.isin(*OBJECT_FOLDERS))
    folder = F.coalesce(F.try_element_at(folders, F.lit(-1)), F.lit(DEFAULT_FOLDER))
    file = F.element_at(parts, -1)
    stem = F.regexp_replace(file, r"(?i)\.sql\z", "")
    dotted = stem.contains(".")
    schema = F.when(dotted, F.substring_index(stem, ".", 1)).otherwise(DEFAULT_SCHEMA)
    name = F.when(dotted, F.regexp_replace(stem, r"\A[^.]*\.", "")).otherwise(stem)
    return F.struct(
        folder.alias("object_type"), schema.alias("schema_name"), name.alias("object_name"),
        F.concat_ws(".", schema, name).alias("full_name"), file.alias("source_file"),
    )


def stable_id(*columns: Column) -> Column:
    """First 16 hex digits of the SHA-1 of the parts joined by a slash."""
    return F.substring(F.sha1(F.concat_ws("/", *columns).cast("binary")), 1, 16)


def ingest_objects(files: DataFrame, patterns=SIGNALS) -> DataFrame:
    """Object rows from scanned files; ``content`` leaves the plan as soon as it is decoded."""
    rows = files.select(
        path_metadata(F.col("path")).alias("m"),
        F.octet_length("content").cast("long").alias("source_bytes"),
        decode_text(F.col("content")).alias("source_sql"),
    ).select("m.*", "source_bytes", "source_sql")
    rows = rows.withColumn("object_id", stable_id(F.col("object_type"), F.col("source_file")))
    profiled = profile_text(rows, "source_sql", "object_type", patterns)
    return profiled.select(
        "object_id", "object_type", "schema_name", "object_name", "full_name", "source_file",
        "source_bytes", "loc", "target_form", "complexity_tier", "complexity_score", "source_sql",
        *[f"sig_{k}" for k in patterns], F.current_timestamp().alias("ingested_at"),
    )
