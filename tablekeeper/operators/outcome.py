"""Outcomes of checking objects: classification, references, staged sets."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import FAILING
from .joins import null_safe, spread_join
from .ranking import SMALL
from .sample import dependency_stage, prefix_sample

# Outcome states, not-found codes, build order of the types, and
# what an error says when the checker was only overloaded.
PASSED = "SUCCEEDED"
BROKEN = ("CANCELED", "CLOSED", "SUBMIT_ERR")
NOT_FOUND = ("TABLE_OR_VIEW_NOT_FOUND", "ROUTINE_NOT_FOUND", "UNRESOLVED_ROUTINE")
BUILD_ORDER = ("SCHEMA", "TABLE", "SYNONYM", "FUNCTION", "VIEW", "PROCEDURE")
TRANSIENT = "rejected from java.util.concurrent"


# Fixed value: how an engine quotes a name; a name is ASCII letters, digits and underscores.
_NAME, _DOT = "[A-Za-z0-9_]+", r"`?\s*\.\s*`?"


def missing_name_pattern(prefix: str) -> str:
    """Object name (group 1) behind a prefixed schema in an error text."""
    return f"{re.escape(prefix)}{_NAME}{_DOT}({_NAME})"


def inventory_names(inventory: DataFrame, name: str) -> DataFrame:
    """Distinct case-folded names as ``_name``."""
    return inventory.select(F.lower(name).alias("_name")).where("_name is not null").distinct()


def classify_outcomes(
    outcomes: DataFrame, inventory: DataFrame, *, name: str, pattern: str, key: str = "object_id"
) -> DataFrame:
    """Add ``valid_status`` to outcomes (``state``, ``error``).

    A not-found error with a readable name is ``sound_dep`` if the inventory
    holds the name and ``unresolved_ext_dep`` if not; other failures are ``fail``. A NULL state is no success.
    Many errors may name one object and most rows name none, so the inventory is
    joined in salted form.
    """
    coded = reduce(lambda a, b: a | b, [F.col("error").contains(c) for c in NOT_FOUND])
    found = F.lower(F.regexp_extract("error", pattern, 1))
    open_case = ~F.coalesce(F.col("state").isin(PASSED, *BROKEN), F.lit(False)) & coded
    named = outcomes.withColumn("_name", F.when(open_case & (found != ""), found))
    known = inventory_names(inventory, name).withColumn("_known", F.lit(True))
    joined = spread_join(named, known, ["_name"], salt_by=[key])
    status = (
        F.when(F.col("state") == PASSED, "pass")
        .when(F.col("_name").isNull(), "fail")
        .when(F.col("_known"), "sound_dep")
        .otherwise("unresolved_ext_dep")
    )
    return joined.withColumn("valid_status", status).select(*outcomes.columns, "valid_status")


def extract_references(df: DataFrame, key: Sequence[str], col: str, pattern: str, group: int = 1) -> DataFrame:
    """One row per key and distinct referenced name (case-folded, ``_name``)."""
    names = F.array_distinct(F.transform(F.regexp_extract_all(F.col(col), F.lit(pattern), F.lit(group)), F.lower))
    return df.select(*key, F.explode(names).alias("_name"))


def referenced_namespaces(
    df: DataFrame, col: str, pattern: str, *, valid: str = r"^[A-Za-z0-9_]+$"
) -> DataFrame:
    """All distinct names the pattern finds in the corpus that are valid identifiers."""
    names = F.array_distinct(F.regexp_extract_all(F.col(col), F.lit(pattern), F.lit(1)))
    found = df.select(F.explode(names).alias("namespace")).select(F.trim("namespace").alias("namespace"))
    return found.where(F.col("namespace").rlike(valid)).distinct()


def resolve_references(
    df: DataFrame, key: Sequence[str], col: str, pattern: str, inventory: DataFrame, *, name: str
) -> DataFrame:
    """Per row of ``df``: references found, references the inventory holds, and whether it holds them all.

    A row without references or text has none, all of them held. ``key`` must identify a row.
    """
    refs = extract_references(df, key, col, pattern)
    known = inventory_names(inventory, name).withColumn("_known", F.lit(True))
    joined = spread_join(refs, known, ["_name"], salt_by=list(key))
    counted = joined.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_refs"), F.count("_known").alias("n_known")
    )
    every = df.select(*key).alias("d").join(counted.alias("c"), null_safe("d", "c", key), "left")
    n_refs, n_known = (F.coalesce(F.col(f"c.{c}"), F.lit(0)).alias(c) for c in ("n_refs", "n_known"))
    return every.select(*[F.col(f"d.`{k}`") for k in key], n_refs, n_known).withColumn("all_known", F.col("n_refs") == F.col("n_known"))


def validation_set(
    objects: DataFrame, fraction: float, *, key: str = "object_id", order: Sequence[str] = BUILD_ORDER,
    small: int = SMALL,
) -> DataFrame:
    """Objects to check: converted, the leading fraction of each type, with a build stage; unknown types come last."""
    ready = objects.where(F.col("converted_code").isNotNull())
    place = dependency_stage(F.col("object_type"), order)
    ready = ready.withColumn("stage_no", F.when(place > 0, place).otherwise(len(order) + 1))
    return prefix_sample(ready, ["object_type"], [key], fraction, small=small)


def to_results(outcomes: DataFrame, run_ts: str | Column, fraction: float | Column) -> DataFrame:
    """Result rows of a run."""
    run = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    share = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return outcomes.select(
        run.alias("run_ts"), share.cast("double").alias("fraction"), "object_id", "object_type", "full_name",
        "valid_status", F.coalesce("error", F.lit("")).alias("valid_error"),
    )


def retry_set(results: DataFrame, marker: str = TRANSIENT, *, object_type: str | None = None) -> DataFrame:
    """Failing rows whose error shows a passing overload."""
    rows = results.where(F.col("valid_status").isin(*FAILING) & F.col("valid_error").contains(marker))
    return rows if object_type is None else rows.where(F.col("object_type") == object_type)
