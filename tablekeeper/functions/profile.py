"""Text profiling: noise removal, signals, line count, score, form and tier."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Signal patterns (matched without regard to case on text whose
# comments and literals are blanked), score weights and tier limits.
SIGNALS = {
    "has_cursor": r"\bDECLARE\b[^;]{0,120}\bCURSOR\b",
    "has_while": r"\bWHILE\b",
    "has_temp_table": r"(#\w+)|\bINTO\s+#",
    "has_table_var": r"\bDECLARE\s+@\w+\s+TABLE\b",
    "has_dynamic_sql": r"\b(EXEC\s*\(|sp_executesql)\b",
    "has_merge": r"\bMERGE\b\s+",
    "has_try_catch": r"\bBEGIN\s+TRY\b",
    "has_transaction": r"\b(BEGIN\s+TRAN|COMMIT\s+TRAN|ROLLBACK)\b",
    "has_pivot": r"\b(PIVOT|UNPIVOT)\b",
    "has_identity": r"\bIDENTITY\s*\(",
    "has_temporal": r"\bSYSTEM_VERSIONING\b|\bPERIOD\s+FOR\s+SYSTEM_TIME\b|\bGENERATED\s+ALWAYS\s+AS\s+ROW\b",
    "has_output_param": r"@\w+\s+\w+(\s*\([^)]*\))?\s+(OUTPUT|OUT)\b",
    "has_cte": r"\bWITH\b[\s\S]{0,200}\bAS\s*\(",
}
WEIGHTS = {
    "has_cursor": 2, "has_dynamic_sql": 2, "has_while": 1, "has_temp_table": 1,
    "has_merge": 1, "has_try_catch": 1, "has_pivot": 1, "has_table_var": 1,
}
LINES_PER_POINT = 200.0
TIERS = (("complex", 4.0, 600), ("medium", 1.5, 150))
DDL_TYPES = ("TABLE", "SCHEMA", "SYNONYM")

# The wide form: EXEC( before a variable or literal and the TRANSACTION spelling count too, and a cursor or a common
# table expression may be declared over any distance.
SIGNALS_WIDE = {
    **SIGNALS,
    "has_cursor": r"\bDECLARE\b[^;]*?\bCURSOR\b",
    "has_cte": r"\bWITH\b[\s\S]*?\bAS\s*\(",
    "has_dynamic_sql": r"\bEXEC(UTE)?\s*\(|\bsp_executesql\b",
    "has_transaction": r"\b(BEGIN|COMMIT)\s+TRAN(SACTION)?\b|\bROLLBACK\b",
}

# Words of which a match of a signal must hold one. Looking for a plain word is
# far cheaper than a pattern, so texts without any are settled by that alone.
NEEDLES = {
    "has_cursor": ("cursor",), "has_while": ("while",), "has_temp_table": ("#",), "has_table_var": ("@",),
    "has_dynamic_sql": ("exec",), "has_merge": ("merge",), "has_try_catch": ("begin",),
    "has_transaction": ("tran", "rollback"), "has_pivot": ("pivot",), "has_identity": ("identity",),
    "has_temporal": ("system_versioning", "period", "generated"), "has_output_param": ("@",), "has_cte": ("with",),
}
# Letters that match an ASCII letter without regard to case but are not its lower case.
_ODD_LETTERS = ("\u017f", "\u0131", "\u0130")

# The possessive groups keep Java's matcher from recursing on long texts.
_BLOCK = r"/\*[^*]*+(?:\*(?!/)[^*]*+)*+\*/"
_LINE = r"--[^\n]*"
_LITERAL = r"'[^']*+'(?:'[^']*+')*+"


def strip_noise(text: Column) -> Column:
    """Blank block comments, then line comments, then quoted literals (which become ``''``)."""
    text = F.regexp_replace(text, _BLOCK, " ")
    text = F.regexp_replace(text, _LINE, " ")
    return F.regexp_replace(text, _LITERAL, "''")


def strip_comments(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, _BLOCK, ""), _LINE, "")


def signal_flags(
    df: DataFrame, col: str, patterns: Mapping[str, str] = SIGNALS, *, prefix: str = "sig_",
    needles: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One boolean column per pattern; word classes and case follow Unicode.

    ``needles`` gives lower-case words every match of a pattern must hold one
    of; patterns without an entry are always tried. By default the patterns of
    this module have theirs, and a caller's own have none.
    """
    if needles is None:
        needles = {k: NEEDLES[k] for k, p in patterns.items() if k in NEEDLES and p in (SIGNALS.get(k), SIGNALS_WIDE.get(k))}
    odd = reduce(or_, [F.col(col).contains(c) for c in _ODD_LETTERS])
    df = df.withColumns({"_folded": F.lower(col), "_odd": odd})

    def flag(name: str, pattern: str) -> Column:
        hit = F.col(col).rlike("(?iU)" + pattern)
        if name not in needles:
            return hit
        return reduce(or_, [F.col("_folded").contains(w) for w in needles[name]], F.col("_odd")) & hit

    return df.withColumns({f"{prefix}{k}": flag(k, p) for k, p in patterns.items()}).drop("_folded", "_odd")


def line_count(stripped: Column) -> Column:
    """Lines of noise-free text; breaks inside block comments are gone by then."""
    return F.size(F.split(stripped, "\n")).cast("long")


def weighted_score(loc: Column, flags: Mapping[str, Column], weights: Mapping[str, float] = WEIGHTS) -> Column:
    score = loc / F.lit(LINES_PER_POINT)
    for name, weight in weights.items():
        if name in flags:
            score = score + F.lit(float(weight)) * flags[name].cast("int")
    return score


def force_flag(flags: Mapping[str, Column]) -> Column:
    """Cursor, dynamic SQL, or a temp table together with a loop."""
    has = {k: flags.get(k, F.lit(False)) for k in ("has_cursor", "has_dynamic_sql", "has_temp_table", "has_while")}
    return has["has_cursor"] | has["has_dynamic_sql"] | (has["has_temp_table"] & has["has_while"])


def target_form(object_type: Column, force: Column) -> Column:
    return (
        F.when(object_type.isin(*DDL_TYPES), "sql_ddl")
        .when(object_type == "VIEW", "sql_view")
        .when(object_type == "FUNCTION", F.when(force, "pyspark").otherwise("sql_function"))
        .otherwise(F.when(force, "pyspark").otherwise("sql_scripting"))
    )


def tier(object_type: Column, score: Column, loc: Column, rules=TIERS, default: str = "simple") -> Column:
    """Cheapest tier that fits; ``rules`` are (label, least score, lines above) from the top down."""
    ladder = F.when(object_type.isin(*DDL_TYPES), "trivial")
    for label, least, lines in rules:
        ladder = ladder.when((score >= least) | (loc > lines), label)
    return ladder.otherwise(default)


def profile_text(
    df: DataFrame, text: str, object_type: str, patterns: Mapping[str, str] = SIGNALS, *,
    weights: Mapping[str, float] = WEIGHTS, force: Callable[[Mapping[str, Column]], Column] = force_flag,
) -> DataFrame:
    """Add ``loc``, ``target_form``, ``complexity_tier``, ``complexity_score`` and the signals.

    Patterns of the caller's own come with ``weights`` by their names and a rule that forces the procedural form; names
    without a pattern count as not found. The stripped text is a column of its own, so it is computed once per row.
    """
    flagged = signal_flags(df.withColumn("_clean", strip_noise(F.col(text))), "_clean", patterns)
    flagged = flagged.withColumn("loc", line_count(F.col("_clean"))).drop("_clean")
    flags = {k: F.col(f"sig_{k}") for k in patterns}
    scored = flagged.withColumn("_score", weighted_score(F.col("loc"), flags, weights))
    kind = F.col(object_type)
    return scored.withColumns(
        {
            "target_form": target_form(kind, force(flags)),
            "complexity_tier": tier(kind, F.col("_score"), F.col("loc")),
            "complexity_score": F.round("_score", 2),
        }
    ).drop("_score")
