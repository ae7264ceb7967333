"""Dates, surrogate date keys and the calendar attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from estrato.functions.text import _col, clean_text

# Text formats, analytic window, sentinel keys and month names.
DATE_FORMAT_BR = "dd/MM/yyyy"
CONTROL_TIMESTAMP_PATTERN = r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$"
CALENDAR_START = dt.date(1990, 1, 1)
CALENDAR_END = dt.date(2050, 12, 31)
MISSING_DATE_SK = -1
OUTSIDE_DATE_SK = -2
MISSING_DATE_NAME = "Não Informado"
OUTSIDE_DATE_NAME = "Fora da Janela Analítica"
MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)


def parse_date_br(value: Column | str) -> Column:
    """Day-first date; NULL for blank, malformed or impossible dates. Any year 0001..9999 is kept."""
    return F.try_to_date(clean_text(value), DATE_FORMAT_BR)


def parse_control_timestamp(value: Column | str) -> Column:
    """Strict day-first timestamp without time zone, NULL when it is not a real calendar moment."""
    text = clean_text(value)
    parts = F.regexp_extract(text, CONTROL_TIMESTAMP_PATTERN, 0)
    day = F.concat_ws("-", F.substring(parts, 7, 4), F.substring(parts, 4, 2), F.substring(parts, 1, 2))
    # put together as text and cast without a zone: no session setting takes part
    iso = F.concat(day, F.lit("T"), F.substring(parts, 12, 8))
    return F.when(parts != "", iso).try_cast("timestamp_ntz")


def yyyymmdd(date: Column | str) -> Column:
    day = _col(date)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_sk(
    date: Column | str, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> Column:
    """Calendar key: yyyymmdd inside the window, one sentinel for NULL and one for dates outside it."""
    day = _col(date)
    return (
        F.when(day.isNull(), MISSING_DATE_SK)
        .when(day.between(F.lit(start), F.lit(end)), yyyymmdd(day))
        .otherwise(OUTSIDE_DATE_SK)
        .cast("int")
    )


def calendar_columns(day: Column | str) -> dict[str, Column]:
    """Attributes of one civil day, by output name. Week days count from 1 = Sunday."""
    d = _col(day)
    weekday = F.dayofweek(d)
    return {
        "data_sk": yyyymmdd(d).cast("int"),
        "data": d,
        "ano": F.year(d),
        "mes": F.month(d),
        "dia": F.dayofmonth(d),
        "trimestre": F.quarter(d),
        "semestre": F.ceil(F.month(d) / 6).cast("int"),
        "dia_semana": weekday,
        "nome_mes": F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(d)),
        "is_fim_de_semana": weekday.isin(1, 7),
    }
