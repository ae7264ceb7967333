"""Named metrics, and the query builder that answers dashboard questions over a serving table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.functions import share
from estrato.functions.numbers import SUM_TYPE
from estrato.session import new_folder


Part = Callable[[], Column]


@dataclass(frozen=True)
class Metric:
    """An aggregate over a table. ``columns`` lists what it reads, ``bridge_safe`` whether it may be
    used on rows reached through a many-to-many bridge (distinct counts only).

    ``parts`` are sums by name that it is made of and ``combine`` makes it of their totals; a metric
    without parts, a distinct count, cannot be added up from groups.
    """

    name: str
    build: Callable[[], Column]
    columns: tuple[str, ...] = ()
    bridge_safe: bool = False
    parts: tuple[tuple[str, Part], ...] = ()
    combine: Callable[[], Column] | None = None


def row_count(name: str) -> Metric:
    return Metric(name, lambda: F.count("*"), parts=(("rows", lambda: F.count("*")),), combine=lambda: F.coalesce(F.sum("rows"), F.lit(0)))


def present_count(name: str, column: str) -> Metric:
    part = f"n_{column}"
    return Metric(name, lambda: F.count(column), (column,), parts=((part, lambda: F.count(column)),), combine=lambda: F.coalesce(F.sum(part), F.lit(0)))


def distinct_count(name: str, column: str, when: str | None = None) -> Metric:
    """Distinct values, or distinct values of rows where another column is present."""
    if when is None:
        return Metric(name, lambda: F.count_distinct(column), (column,), True)
    build = lambda: F.count_distinct(F.when(F.col(when).isNotNull(), F.col(column)))
    return Metric(name, build, (column, when), True)


def total(name: str, column: str) -> Metric:
    part = f"sum_{column}"
    build = lambda: F.sum(F.col(column).cast(SUM_TYPE)).cast(SUM_TYPE)
    return Metric(name, build, (column,), parts=((part, build),), combine=lambda: F.sum(part).cast(SUM_TYPE))


def ratio(name: str, top: Metric, bottom: Metric, scale: float = 100.0, digits: int = 6) -> Metric:
    """scale * top / bottom from the summed parts, never from averaged ratios; NULL on zero."""
    build = lambda: F.round(share(top.build(), bottom.build()) * scale, digits)
    combine = (lambda: F.round(share(top.combine(), bottom.combine()) * scale, digits)) if top.combine and bottom.combine else None
    parts = tuple({**dict(top.parts), **dict(bottom.parts)}.items()) if combine else ()
    return Metric(name, build, tuple({*top.columns, *bottom.columns}), top.bridge_safe and bottom.bridge_safe, parts, combine)


def where_any(filters: Mapping[str, Sequence] | None) -> Column | None:
    """Multi-select filters: any value within a column, all columns together, empty lists ignored."""
    parts = [F.col(c).isin(list(values)) for c, values in (filters or {}).items() if values]
    return reduce(lambda a, b: a & b, parts) if parts else None


def summarize(
    table: DataFrame,
    metrics: Sequence[Metric],
    dims: Sequence[str] = (),
    filters: Mapping[str, Sequence] | None = None,
    not_null: Sequence[str] = (),
    order: Sequence[Column] = (),
    limit: int | None = None,
    through_bridge: bool = False,
) -> DataFrame:
    """One grouped query. A table that joins facts through a bridge only accepts bridge-safe metrics."""
    if through_bridge:
        unsafe = [m.name for m in metrics if not m.bridge_safe]
        if unsafe:
            raise ValueError(f"not additive through a many-to-many bridge: {unsafe}")
    condition = where_any(filters)
    rows = table if condition is None else table.filter(condition)
    for column in not_null:
        rows = rows.filter(F.col(column).isNotNull())
    result = rows.groupBy(*dims).agg(*[m.build().alias(m.name) for m in metrics])
    if order:
        result = result.orderBy(*order)
    return result if limit is None else result.limit(limit)


def filter_values(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The values offered by each selector, with their row counts, in one scan.

    Rows are first counted per value inside each task, so a value held by most rows is no hot spot.
    """
    named = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    return (
        table.select(F.explode(F.array(*named)).alias("item"))
        .select("item.column_name", "item.value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n_rows"))
    )


def count_equivalence(
    table: DataFrame, dims: Sequence[str], key: str, rows_metric: Metric, keep: Column | None = None
) -> DataFrame:
    """Per dimension: groups where a plain count differs from the distinct count it is to replace.

    One scan for all dimensions: rows are counted per (dimension, group, key), then per group.
    """
    if len(rows_metric.parts) != 1:
        raise ValueError(f"{rows_metric.name} is no plain count")
    name, part = rows_metric.parts[0]
    rows = table if keep is None else table.filter(keep)
    # the key is repeated under a name of its own: a counted column must not be one that grouping sets blank out
    rows = rows.select(*dims, F.col(key).alias("__key"), *rows_metric.columns)
    per_key = rows.groupingSets([[d, "__key"] for d in dims], *dims, "__key").agg(F.grouping_id().alias("__set"), part().alias(name))
    per_group = per_key.groupBy("__set", *dims).agg(F.sum(name).alias("plain_count"), F.count("__key").alias("distinct_count"))
    names = F.create_map(*[F.lit(x) for i, d in enumerate(dims) for x in (_set_id([d, "__key"], [*dims, "__key"]), d)])
    return per_group.groupBy(names[F.col("__set")].alias("dimension")).agg(
        F.count("*").alias("n_groups"),
        F.count_if(F.col("plain_count") != F.col("distinct_count")).alias("n_different"),
    )


def _set_id(chosen: Sequence[str], columns: Sequence[str]) -> int:
    """Spark's grouping_id of a set: a bit for every column that is not in it, the first column's highest."""
    out = 0
    for c in columns:
        out = 2 * out + (c not in chosen)
    return out


class NotAdditive(ValueError):
    """A question that no stored aggregate can answer."""


@dataclass(frozen=True)
class Cube:
    """Sums of a table by several sets of dimensions, made in one scan; questions are answered from the smallest set that holds them."""

    rows: DataFrame
    dims: tuple[str, ...]
    sizes: Mapping[frozenset[str], int]
    parts: frozenset[str]

    def answer(self, metrics: Sequence[Metric], dims: Sequence[str] = (), filters: Mapping[str, Sequence] | None = None,
               not_null: Sequence[str] = (), order: Sequence[Column] = (), limit: int | None = None) -> DataFrame:
        """As ``summarize`` over the table itself. Metrics that don't add up, or were not summed, are refused."""
        wrong = [m.name for m in metrics if m.combine is None or not {n for n, _ in m.parts} <= self.parts]
        needed = {*dims, *not_null, *(c for c, values in (filters or {}).items() if values)}
        fitting = [s for s in self.sizes if needed <= s]
        if wrong or not fitting:
            raise NotAdditive(f"cannot add up {wrong}" if wrong else f"no aggregate holds {sorted(needed)}")
        chosen = min(fitting, key=lambda s: (self.sizes[s], len(s), sorted(s)))
        rows = self.rows.filter(F.col("grouping") == _set_id(list(chosen), self.dims))
        condition = where_any(filters)
        rows = rows if condition is None else rows.filter(condition)
        for column in not_null:
            rows = rows.filter(F.col(column).isNotNull())
        result = rows.groupBy(*dims).agg(*[m.combine().alias(m.name) for m in metrics])
        if order:
            result = result.orderBy(*order)
        return result if limit is None else result.limit(limit)


def cube(table: DataFrame, groupings: Sequence[Sequence[str]], metrics: Sequence[Metric]) -> Cube:
    """Sums for every metric by each of the groupings, from one scan of the table, written as one small table.

    Rows are summed per group inside each task first, so a group that holds most rows is one row a task.
    """
    refused = [m.name for m in metrics if m.combine is None]
    if refused:
        raise NotAdditive(f"cannot add up {refused}")
    dims = tuple(dict.fromkeys(d for g in groupings for d in g))
    parts = dict(p for m in metrics for p in m.parts)
    needed = {c for m in metrics for c in m.columns}
    # grouping sets blank out the columns they leave out; a dimension that is also summed is kept apart by the optimizer
    rows = table.select(*dims, *sorted(needed - set(dims)))
    if dims:
        summed = rows.groupingSets([list(g) for g in groupings], *dims).agg(F.grouping_id().cast("int").alias("grouping"), *[p().alias(n) for n, p in parts.items()])
    else:
        summed = rows.agg(F.lit(0).alias("grouping"), *[p().alias(n) for n, p in parts.items()])
    folder = new_folder(table.sparkSession, "cube")
    summed.write.parquet(folder)
    stored = table.sparkSession.read.schema(summed.schema).parquet(folder)
    counted = {r["grouping"]: r["count"] for r in stored.groupBy("grouping").count().collect()}  # a row per grouping
    sizes = {frozenset(g): counted.get(_set_id(list(g), dims), 0) for g in groupings}
    return Cube(stored, dims, sizes, frozenset(parts))
