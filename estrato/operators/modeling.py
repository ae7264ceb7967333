"""Dimensional modelling: canonical facts, conformed dimensions, calendar and the star view."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.functions import CALENDAR_END, CALENDAR_START, MISSING_DATE_SK, OUTSIDE_DATE_SK, calendar_columns
from estrato.functions.dates import MISSING_DATE_NAME, OUTSIDE_DATE_NAME
from estrato.operators.skew import salted_join


def distinct_rows(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Distinct tuples. The shuffle key is the whole tuple, so no single key can overload a task."""
    return df.select(*columns).distinct()


def canonical_rows(df: DataFrame, stable_columns: Sequence[str]) -> DataFrame:
    """One row per distinct stable tuple, leaving out columns that vary between observations.

    No row is ever chosen over another: a key whose stable columns disagree keeps all its tuples,
    and the stability check reports it.
    """
    return distinct_rows(df, stable_columns)


def conformed_roles(roles: Iterable[tuple[DataFrame, str, str, dict[str, bool]]], code: str, label: str) -> DataFrame:
    """One dimension out of several (table, code column, label column, role flags).

    Each role is first reduced to its distinct (code, label) pairs; a flag is true when any role sets it.
    """
    parts: DataFrame | None = None
    flags: list[str] = []
    for df, code_column, label_column, role_flags in roles:
        part = df.select(F.col(code_column).alias(code), F.col(label_column).alias(label)).distinct()
        part = part.select(code, label, *[F.lit(v).alias(f) for f, v in role_flags.items()])
        flags = flags or list(role_flags)
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy(code, label).agg(*[F.bool_or(f).alias(f) for f in flags])


def calendar(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    """One row per civil day in the window plus the two sentinel rows. Its size depends on the window only."""
    spine = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("__day"))
    attributes = calendar_columns("__day")
    days = spine.select(*[c.alias(n) for n, c in attributes.items()])
    sentinels = spark.createDataFrame(
        [(MISSING_DATE_SK, MISSING_DATE_NAME), (OUTSIDE_DATE_SK, OUTSIDE_DATE_NAME)],
        "data_sk int, nome_mes string",
    )
    return days.unionByName(sentinels, allowMissingColumns=True)


@dataclass(frozen=True)
class Role:
    """A joined table in one role: how it is reached and which of its columns appear under which names."""

    table: Callable[[], DataFrame]  # defined only when the role is needed
    left_key: str
    right_key: str
    outputs: dict[str, str]  # output name -> column of the joined table
    bounded: bool = False  # size proven independent of the data (the calendar)
    carries: tuple[str, ...] = ()  # columns kept only for roles that are reached through this one
    proven: bool = False  # the key was found unique by a gate; else uniqueness is checked while joining
    spread_by: str | None = None  # fact column that spreads very hot keys over sub-keys (salted_join)
    hot: Mapping | None = None  # the hot keys and their numbers of sub-keys, where a write has observed them


def _one_per_key(side: DataFrame, key: str, name: str) -> DataFrame:
    """The side itself; an error at run time where a key repeats. NULL keys match nothing and may repeat."""
    others = [c for c in side.columns if c != key]
    grouped = side.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"), *[F.first(c).alias(c) for c in others])
    repeated = F.raise_error(F.concat(F.lit(f"{name}: repeated key "), F.col(key).cast("string"))).cast(side.schema[key].dataType)
    return grouped.select(F.when(F.col("__n") > 1, repeated).otherwise(F.col(key)).alias(key), *others)


def star_view(
    fact: DataFrame,
    fact_columns: dict[str, str | Column],
    roles: Sequence[tuple[str, Role]],
    order: Sequence[str],
    wanted: Sequence[str] | None = None,
    derived: dict[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Left-joins the roles to the fact and names the result columns.

    Every role must be unique on its key. A role that carries no proof of that is brought to one row
    per key as it is joined, and a key that repeats there fails the job instead of multiplying rows.
    A role that contributes no wanted column, and reaches no other needed role, is not joined at all:
    the grain cannot change. ``derived`` maps an output to (needed role, expression over outputs).
    """
    derived = derived or {}
    wanted = list(wanted) if wanted is not None else list(order)
    needed_outputs = set(wanted)
    needed_roles = {derived[w][0] for w in wanted if w in derived}
    by_name = dict(roles)
    for name, role in roles:
        if needed_outputs & set(role.outputs):
            needed_roles.add(name)
    for name, role in reversed(list(roles)):
        if name in needed_roles:
            for other_name, other in roles:
                if role.left_key in other.carries or role.left_key in other.outputs:
                    needed_roles.add(other_name)

    keys = {by_name[n].left_key for n in needed_roles}
    selected = [
        (F.col(c) if isinstance(c, str) else c).alias(n)
        for n, c in fact_columns.items()
        if n in needed_outputs or n in keys
    ]
    carried = {c for r in by_name.values() for c in (*r.carries, *r.outputs)}
    keys |= {by_name[n].spread_by for n in needed_roles if by_name[n].spread_by}
    selected += [F.col(fact_columns[k]).alias(k) for k in sorted(keys) if isinstance(fact_columns.get(k), str) and k not in needed_outputs and k not in {by_name[n].left_key for n in needed_roles}]
    plain_keys = [k for k in sorted(keys) if k not in fact_columns and k not in carried]
    result = fact.select(*selected, *plain_keys)
    for name, role in roles:
        if name not in needed_roles:
            continue
        marker = f"__{name}_key"
        derived_here = {d for d, (r, _) in derived.items() if r == name and d in needed_outputs}
        side_columns = [
            F.col(c).alias(o)
            for o, c in role.outputs.items()
            if o in needed_outputs or o in keys or derived_here
        ]
        side_columns += [F.col(c) for c in role.carries if c in keys]
        side = role.table().select(F.col(role.right_key).alias(marker), *side_columns)
        if not role.proven:
            side = _one_per_key(side, marker, name)
        if role.spread_by:
            side = side.withColumnRenamed(marker, role.left_key)
            result = salted_join(result, side, role.left_key, role.spread_by, hot=role.hot)
            continue
        if role.bounded:
            side = F.broadcast(side)
        result = result.join(side, result[role.left_key] == side[marker], "left").drop(marker)
    for name, (_, expression) in derived.items():
        if name in needed_outputs:
            result = result.withColumn(name, expression)
    return result.select(*[c for c in order if c in needed_outputs])
