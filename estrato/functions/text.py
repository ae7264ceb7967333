"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The only spellings read as true / false, after trimming and upper-casing.
YES_TEXT = "SIM"
NO_TEXT = "NÃO"
# Fixed value: characters allowed in run and dataset ids.
SAFE_ID_PATTERN = "^[A-Za-z0-9_.-]+$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    """Empty string becomes NULL; the text is otherwise untouched."""
    return F.nullif(_col(value), F.lit(""))


def clean_text(value: Column | str) -> Column:
    """Outer spaces removed (spaces only, not tabs or line ends), empty becomes NULL."""
    return blank_to_null(F.trim(_col(value)))


def clean_upper(value: Column | str) -> Column:
    return F.upper(clean_text(value))


def dash_to_null(value: Column | str) -> Column:
    """Like clean_text, and a lone dash also means "no value"."""
    return F.nullif(clean_text(value), F.lit("-"))


def is_blank_only(value: Column | str) -> Column:
    """True for text made of one or more spaces and nothing else."""
    text = _col(value)
    return (F.length(text) > 0) & (F.trim(text) == "")


def parse_yes_no(value: Column | str) -> Column:
    """Three-valued: true, false, or NULL for anything else. Accents matter."""
    text = F.upper(F.trim(_col(value)))
    return F.when(text == YES_TEXT, True).when(text == NO_TEXT, False)


def is_safe_id(value: Column | str) -> Column:
    return _col(value).rlike(SAFE_ID_PATTERN)


def normalize_location(value: Column | str) -> Column:
    """Storage location without outer spaces and trailing slashes; NULL reads as empty."""
    return F.coalesce(F.regexp_replace(F.trim(_col(value)), "/+$", ""), F.lit(""))


def json_list(*values: Column | str) -> Column:
    return F.to_json(F.array(*[_col(v) for v in values]))
