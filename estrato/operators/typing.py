"""Rename-and-type projections described by a small table of fields."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.functions import (
    clean_text,
    clean_upper,
    dash_to_null,
    parse_date_br,
    parse_decimal_br,
    parse_yes_no,
)
from estrato.functions.text import _col


def _whole(kind: str) -> Callable[[Column | str], Column]:
    return lambda value: _col(value).try_cast(kind)


KINDS: dict[str, Callable[[Column | str], Column]] = {
    "text": clean_text,
    "upper": clean_upper,
    "dash": dash_to_null,
    "long": _whole("bigint"),
    "int": _whole("int"),
    "short": _whole("smallint"),
    "date": parse_date_br,
    "money": parse_decimal_br,
    "flag": parse_yes_no,
}


@dataclass(frozen=True)
class Field:
    """One typed output column: its name, the raw column it reads and how it is read."""

    name: str
    source: str
    kind: str

    def column(self) -> Column:
        return KINDS[self.kind](self.source).alias(self.name)


def fields_from_text(table: str) -> tuple[Field, ...]:
    """Reads ``name source kind`` lines."""
    return tuple(Field(*line.split()) for line in table.strip().splitlines() if line.strip())


def project_typed(
    df: DataFrame,
    fields: Sequence[Field],
    first: Iterable[Column] = (),
    last: Iterable[Column | str] = (),
) -> DataFrame:
    """Typed projection; ``first`` and ``last`` are extra columns placed around the typed ones."""
    return df.select(*first, *[f.column() for f in fields], *last)


def parse_loss(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Per typed column: raw values that are not blank but typed to NULL. One scan, one row per column.

    Comparing sums before and after typing cannot see text that is NULL on both sides; this can.
    """
    typed = [f for f in fields if f.kind not in ("text", "upper", "dash")]
    counts = df.agg(
        *[
            F.count_if(clean_text(f.source).isNotNull() & f.column().isNull()).alias(f.name)
            for f in typed
        ],
        F.count("*").alias("total_rows"),
    )
    return unpivot_counts(counts, [f.name for f in typed], "column_name", "lost_rows", ["total_rows"])


def unpivot_counts(
    one_row: DataFrame, columns: Sequence[str], name: str, value: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Turns a one-row wide aggregate into one row per column."""
    return one_row.unpivot(list(keep), list(columns), name, value).select(name, value, *keep)
