"""Declared types, temporal tables and their keys."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import stable_id
from .joins import spread_join
from .scd2 import AUDIT_PREFIX

# Declared T-SQL types and the engine types they become.
TYPES = {
    "nvarchar": "STRING", "varchar": "STRING", "char": "STRING", "nchar": "STRING",
    "text": "STRING", "ntext": "STRING", "sysname": "STRING", "uniqueidentifier": "STRING",
    "xml": "STRING", "time": "STRING", "bit": "BOOLEAN",
    "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INT", "integer": "INT", "bigint": "BIGINT",
    "datetime": "TIMESTAMP", "datetime2": "TIMESTAMP", "smalldatetime": "TIMESTAMP",
    "datetimeoffset": "TIMESTAMP", "date": "DATE",
    "money": "DECIMAL(19,4)", "smallmoney": "DECIMAL(19,4)", "float": "DOUBLE", "real": "FLOAT",
    "binary": "BINARY", "varbinary": "BINARY", "image": "BINARY", "rowversion": "BINARY", "timestamp": "BINARY",
}
DEFAULT_TYPE = "STRING"
DEFAULT_DECIMAL = "DECIMAL(38,18)"
COMPANION_SUFFIX = "_scd2_apply"
COMPANION = {
    "object_type": "PROCEDURE", "target_form": "sql_scripting", "complexity_tier": "generated",
    "method": "scd2_generator",
}


def engine_type(declared: str, *, widen_tinyint: bool = False) -> str:
    """Engine type of a declared one such as ``decimal(10,2)``; unknown types are strings.

    Source ``tinyint`` may be unsigned: ``widen_tinyint`` makes it SMALLINT.
    """
    name, _, args = declared.strip().lower().partition("(")
    name, args = name.strip(), re.sub(r"\s", "", args.rstrip(") "))
    if name in ("decimal", "numeric"):
        return f"DECIMAL({args})" if args and args != "max" else DEFAULT_DECIMAL
    if name == "tinyint" and widen_tinyint:
        return "SMALLINT"
    return TYPES.get(name, DEFAULT_TYPE)


_WHOLE = {"TINYINT": 7, "SMALLINT": 15, "INT": 31, "BIGINT": 63}


def _cast(column: Column, kind: T.DataType, target: str) -> Column:
    """``try_cast``, with the common misfits of whole numbers sorted out by a test first.

    A failing ``try_cast`` to a whole number raises and catches an exception per
    row, which costs far more than the test.
    """
    cast = column.try_cast(target)
    if target not in _WHOLE:
        return cast
    if isinstance(kind, T.IntegralType):
        bound = 1 << _WHOLE[target]
        return F.when(column.between(F.lit(-bound), F.lit(bound - 1)), cast)
    if isinstance(kind, T.StringType):
        return F.when(column.rlike(r"^[^0-9A-Za-z]*[0-9]+[^0-9A-Za-z]*$"), cast)
    return cast


def _casts(df: DataFrame, declared: Mapping[str, str], **options) -> dict[str, Column]:
    return {
        c: _cast(F.col(f"`{c}`"), df.schema[c].dataType, engine_type(t, **options)) for c, t in declared.items()
    }


def conform_types(
    df: DataFrame, declared: Mapping[str, str], *, failures: str | None = None, widen_tinyint: bool = False
) -> DataFrame:
    """Cast the declared columns; values that do not fit become NULL.

    ``failures`` names a column that lists, per row, the columns whose value was lost.
    """
    casts = _casts(df, declared, widen_tinyint=widen_tinyint)
    columns = [casts[c].alias(c) if c in casts else F.col(f"`{c}`") for c in df.columns]
    if not failures:
        return df.select(*columns)
    # a projection of its own holds the cast values, so none is cast again to be tested
    given = [F.col(f"`{c}`").isNotNull().alias(f"_had_{c}") for c in casts]
    cast = df.select(*columns, *given)
    lost = [F.when(F.col(f"`_had_{c}`") & F.col(f"`{c}`").isNull(), F.lit(c)) for c in casts]
    return cast.select(*[F.col(f"`{c}`") for c in df.columns], F.array_compact(F.array(*lost)).alias(failures))


def conform_report(df: DataFrame, declared: Mapping[str, str], *, widen_tinyint: bool = False) -> DataFrame:
    """Per declared column the engine type, the values present and the casts that fail; one scan."""
    casts = _casts(df, declared, widen_tinyint=widen_tinyint)
    present = {c: F.count(F.col(f"`{c}`")) for c in casts}
    kept = {c: F.count(v) for c, v in casts.items()}
    one = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(engine_type(declared[c], widen_tinyint=widen_tinyint)).alias("engine_type"),
                    present[c].alias("n_values"),
                    (present[c] - kept[c]).alias("n_failed"),
                )
                for c in casts
            ]
        ).alias("rows")
    )
    return one.select(F.explode("rows").alias("r")).select("r.*")


# --- temporal tables --------------------------------------------------------

def select_temporal(
    objects: DataFrame, signals: DataFrame, meta: DataFrame, *, flag: str = "sig_has_temporal"
) -> DataFrame:
    """Tables with the temporal signal and whether usable metadata (``full_name``) exists for them."""
    flagged = signals.where(F.col(flag)).select("object_id")
    known = meta.select("full_name").distinct().withColumn("has_meta", F.lit(True))
    return (
        objects.where(F.col("object_type") == "TABLE")
        .join(flagged, "object_id", "left_semi")
        .join(known, "full_name", "left")
        .withColumn("has_meta", F.coalesce("has_meta", F.lit(False)))
    )


def infer_business_key(columns_meta: DataFrame, keys_meta: DataFrame, *, table: str = "table") -> DataFrame:
    """Key columns per table, one row each: ``table, position, column, rule``.

    The primary key without identity columns; else the unique columns; else all
    columns that are no period, identity or audit column, marked for review.
    Rows stay rows throughout, so a table with very many columns is no special case.
    """
    identity = (
        columns_meta.where(F.col("identity")).select(table, F.lower("name").alias("_name")).distinct()
    )
    primary = keys_meta.select(table, F.posexplode("pk").alias("position", "column"))
    natural = (
        primary.withColumn("_name", F.lower("column"))
        .join(identity, [table, "_name"], "left_anti")
        .select(table, "position", "column", F.lit("primary_key").alias("rule"))
    )
    has_natural = natural.select(table).distinct()
    unique = (
        keys_meta.join(has_natural, table, "left_anti")
        .select(table, F.posexplode("unique").alias("position", "column"))
        .withColumn("rule", F.lit("unique_constraint"))
    )
    has_key = has_natural.union(unique.select(table).distinct()).withColumn("_keyed", F.lit(True))
    # a table may own a large share of the columns: the flag is joined in salted form
    plain = spread_join(
        columns_meta.where(
            ~F.coalesce("row_start", F.lit(False)) & ~F.coalesce("row_end", F.lit(False))
            & ~F.coalesce("identity", F.lit(False)) & ~F.upper("name").startswith(AUDIT_PREFIX)
        ),
        has_key, [table], salt_by=[table, "name"],
    )
    rest = plain.where(F.col("_keyed").isNull()).select(
        table, F.col("ordinal").cast("int").alias("position"), F.col("name").alias("column"),
        F.lit("all_columns_review").alias("rule"),
    )
    return natural.unionByName(unique).unionByName(rest)


def register_companions(tables: DataFrame, code: Column | None = None) -> DataFrame:
    """One derived procedure object per temporal table (``schema_name``, ``object_name``), with a stable id."""
    name = F.concat(F.col("object_name"), F.lit(COMPANION_SUFFIX))
    full = F.concat_ws(".", F.col("schema_name"), name)
    text = F.lit(None).cast("string") if code is None else code
    return tables.select(
        stable_id(F.lit(COMPANION["object_type"]), full).alias("object_id"),
        F.lit(COMPANION["object_type"]).alias("object_type"),
        F.col("schema_name"), name.alias("object_name"), full.alias("full_name"),
        F.lit(COMPANION["target_form"]).alias("target_form"),
        F.lit(COMPANION["complexity_tier"]).alias("complexity_tier"),
        F.lit(0).cast("long").alias("source_bytes"), F.lit(False).alias("oversized"),
        F.lit(COMPANION["method"]).alias("method"),
        F.lit(None).cast("string").alias("model_endpoint"), F.lit(None).cast("string").alias("convert_error"),
        text.alias("raw_code"), F.lit(1).alias("attempt"), text.alias("converted_code"),
    )
