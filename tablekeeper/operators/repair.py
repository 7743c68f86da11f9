"""Error-driven repair in bounded passes."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import FAILING
from ..functions.rewrite import clean_output, is_python, looks_truncated, strip_prefix
from ..sources.tables import stage
from .merge import merge_update

# What a fix must stay, by the kind of object.
DIRECTIVES = {
    "VIEW": "Keep it one CREATE OR REPLACE VIEW statement.",
    "TABLE": "Keep it one CREATE TABLE statement.",
    "PYTHON": "Keep it a Python function and change only what stops it from compiling.",
    "PROCEDURE": "Keep it one CREATE PROCEDURE statement.",
    "FUNCTION": "Keep it one CREATE FUNCTION statement.",
}


def directive(object_type: Column, code: Column, texts: Mapping[str, str] = DIRECTIVES) -> Column:
    return (
        F.when(object_type == "VIEW", texts["VIEW"])
        .when(object_type == "TABLE", texts["TABLE"])
        .when(is_python(code), texts["PYTHON"])
        .when(object_type == "PROCEDURE", texts["PROCEDURE"])
        .otherwise(texts["FUNCTION"])
    )


def repair_context(failing: DataFrame, prefix: str, texts: Mapping[str, str] = DIRECTIVES) -> DataFrame:
    """What a repair function gets: directive, error and prior text, both free of the check prefix."""
    code = strip_prefix(F.col("converted_code"), prefix)
    error = strip_prefix(F.coalesce("valid_error", F.lit("")), prefix)
    return failing.select(
        "object_id", "object_type", "full_name",
        directive(F.col("object_type"), F.col("converted_code"), texts).alias("directive"),
        error.alias("error"), code.alias("code"),
    )


def repair_until(
    converted: DataFrame,
    results: DataFrame,
    run_ts: str,
    repair_fn: Callable[[DataFrame, int], DataFrame],
    check_fn: Callable[[DataFrame], DataFrame],
    *,
    passes: int = 2,
    prefix: str = "_check__",
) -> tuple[DataFrame, DataFrame]:
    """Repair the failing objects of a run until none fails or ``passes`` are used up.

    ``repair_fn(context, pass_no)`` returns ``object_id, object_type, fixed``;
    ``check_fn(fixes)`` gets ``object_id, object_type, code`` and returns
    ``object_id, valid_status, valid_error``. A fix that is cut off is dropped,
    any other replaces the prior text and raises ``attempt``, even if it fails again.
    Only the failing objects go through the passes; each pass writes them once, so a
    lost executor repeats at most one pass and no repair is called twice. Both
    relations take over the outcome in one merge at the end.
    """
    of_run = F.col("run_ts") == run_ts
    errors = results.where(of_run & F.col("valid_status").isin(*FAILING)).select("object_id", "valid_status", "valid_error")
    known = converted.select("object_id", "object_type", "full_name", "converted_code", "attempt")
    live = stage(errors.join(known, "object_id"), "failing")
    for number in range(passes):
        failing = live.where(F.col("valid_status").isin(*FAILING))
        if failing.isEmpty():
            break
        answered = repair_fn(repair_context(failing, prefix), number)
        fixes = answered.select(
            "object_id", "object_type", strip_prefix(clean_output(F.col("fixed")), prefix).alias("code")
        )
        # the answers are written before they are read for the check and the merges
        fixes = stage(fixes.where(~looks_truncated(F.col("code"))), "fixes")
        checked = stage(check_fn(fixes).select("object_id", "valid_status", "valid_error"), "checked")
        fixed = merge_update(
            live, fixes, ["object_id"], {"converted_code": F.col("s.code"), "attempt": F.col("t.attempt") + 1}
        )
        live = stage(
            merge_update(
                fixed, checked, ["object_id"],
                {"valid_status": F.col("s.valid_status"), "valid_error": F.coalesce("s.valid_error", F.lit(""))},
            ),
            "failing",
        )
    converted = merge_update(
        converted, live, ["object_id"],
        {"converted_code": F.col("s.converted_code"), "attempt": F.col("s.attempt")},
    )
    results = merge_update(
        results, live, ["object_id"],
        {"valid_status": F.col("s.valid_status"), "valid_error": F.col("s.valid_error")},
        target_pred=F.col("t.run_ts") == run_ts,
    )
    return converted, results
