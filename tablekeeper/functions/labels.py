"""Label ladders, success test, excerpts and templates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Statuses, ladders (first hit wins; LIKE patterns, so "_" is any
# one character) and excerpt lengths.
SUCCESS = ("pass", "unresolved_ext_dep", "sound_dep")
SOUND = ("unresolved_ext_dep", "sound_dep")
FAILING = ("fail", "timeout")
REVIEW_CLASSES = (
    ("%ONLY_AT_BEGINNING%", "declare_placement"),
    ("%MATCHED%", "merge_syntax"),
    ("%DELTA_INVALID_CHARACTERS%", "column_name_chars"),
    ("%missing%", "statement_termination"),
    ("%end of input%", "unclosed_block"),
    ("%PYTHON_SYNTAX%", "pyspark_syntax"),
    ("%PARSE_SYNTAX%", "parse_other"),
    ("%UNRESOLVED_COLUMN%", "unresolved_column"),
    ("%NOT_FOUND%", "missing_dependency"),
)
CHART_CLASSES = (
    ("%PARSE_SYNTAX_ERROR%", "parse syntax"),
    ("%PYTHON_SYNTAX%", "python syntax"),
    ("%UNRESOLVED_COLUMN%", "unresolved column"),
    ("%IDENTIFIER_TOO_MANY_NAME_PARTS%", "cross-db 3-part name"),
    ("%UNRESOLVABLE_TABLE_VALUED_FUNCTION%", "TVF unresolved"),
)
REVIEW_CHARS = 1000
CHART_CHARS = 220


def is_success(status: Column) -> Column:
    return status.isin(*SUCCESS)


def classify_text(
    text: Column,
    rules: Sequence[tuple[str, str]] = REVIEW_CLASSES,
    *,
    status: Column | None = None,
    timeout_label: str = "timeout",
    default: str = "other",
) -> Column:
    """Label of the first LIKE rule that hits; a timeout status is asked after the text."""
    ladder = None
    for pattern, label in rules:
        hit = text.like(pattern)
        ladder = F.when(hit, label) if ladder is None else ladder.when(hit, label)
    if status is not None:
        ladder = ladder.when(status == "timeout", timeout_label)
    return ladder.otherwise(default)


def status_label(status: Column) -> Column:
    return (
        F.when(status == "pass", "1 pass")
        .when(status.isin(*SOUND), "2 sound (dep)")
        .when(status == "timeout", "3 timeout")
        .otherwise("4 fail")
    )


def excerpt(text: Column, n: int = REVIEW_CHARS) -> Column:
    """First ``n`` characters on one line."""
    return F.substring(F.translate(text, "\n", " "), 1, n)


def ci_eq(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)


def axis_label(number: Column) -> Column:
    return number.cast("string")


def render_template(template: Column, values: Mapping[str, Column]) -> Column:
    """Replace each ``{name}`` by its value; NULL for a NULL template, NULL values render empty.

    All names are filled in one pass: a value that itself holds ``{other}`` stays as it is.
    """
    pieces = F.split(template, r"(?=\{)|(?<=\})")
    table = F.create_map(
        *[x for k, v in values.items() for x in (F.lit("{" + k + "}"), F.coalesce(v.cast("string"), F.lit("")))]
    )
    filled = F.transform(pieces, lambda p: F.coalesce(F.element_at(table, p), p))
    return F.array_join(filled, "")


def lookup(column: Column, mapping: Mapping[str, str]) -> Column:
    """Value of a small literal map; NULL for keys it does not hold."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.element_at(F.create_map(*pairs), column)


def flag_oversized(size: Column, limit: int | None = None) -> Column:
    """Rows over a limit the caller sets, in the unit of ``size``; without one no row is too large."""
    return F.lit(False) if limit is None else F.coalesce(size > F.lit(limit), F.lit(False))
