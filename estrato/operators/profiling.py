"""Table profiles: columns, candidate keys, functional dependencies, duplicates, dates, lineage.

Counts, lengths and sketches of distinct values of any number of columns come from one plain
aggregate. Exact distinct counts follow from what it found: columns with few values together, each
other one by a scan that reads it alone, counted inside the tasks first; long text takes part by its
digest and never is a grouping key itself. Rows are not expanded.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.functions import concat_key, is_blank_only, percent
from estrato.functions.keys import CONCAT_NULL
from estrato.operators.skew import key_counts, repeated_keys


def as_pairs(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), cast: str | None = "string") -> DataFrame:
    """One (column_name, value) row per column of each row, plus the kept columns."""
    value = (lambda c: F.col(c).cast(cast)) if cast else F.col
    pairs = [F.struct(F.lit(c).alias("column_name"), value(c).alias("value")) for c in columns]
    return df.select(*keep, F.explode(F.array(*pairs)).alias("__pair")).select(
        *keep, "__pair.column_name", "__pair.value"
    )


def value_key(value: Column) -> Column:
    """The value itself, or a 256-bit digest of text longer than that (marked, so the two never meet)."""
    return F.when(F.length(value) > 64, F.concat(F.lit("#"), F.sha2(value, 256))).otherwise(value)


PLAIN_TYPES = (T.StringType, T.IntegralType, T.DecimalType, T.DateType, T.BooleanType)
"""Types whose values are equal where their texts are; other types are counted as text."""
FEW = 4000
"""Columns with about this many distinct values at most are counted together, by sets in one aggregate."""


def _counted_value(df: DataFrame, column: str, longest: int | None) -> Column:
    """What stands for a column's values when they are counted: the values, or digests where there is long text."""
    plain = isinstance(df.schema[column].dataType, PLAIN_TYPES)
    value = F.col(column) if plain else F.col(column).cast("string")
    return value_key(value.cast("string")) if (longest or 0) > 64 else value


def _wide_statistics(df: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """Counts, lengths and a mergeable sketch of the distinct values of every column: two plain aggregates."""
    statistics = {
        "null_count": lambda v: F.count_if(v.isNull()),
        "empty_count": lambda v: F.count_if(v.isNotNull() & (F.trim(v) == "")),
        "blank_count": lambda v: F.count_if(F.coalesce(is_blank_only(v), F.lit(False))),
        "min_length": lambda v: F.min(F.length(v)),
        "max_length": lambda v: F.max(F.length(v)),
    }
    text = [F.col(c).cast("string") for c in columns]
    # sketches run outside generated code; in one aggregate with them the counts would too
    row = df.agg(F.count("*").alias("total_rows"), *[f(v).alias(f"{n}_{i}") for i, v in enumerate(text) for n, f in statistics.items()]).first()
    about = df.agg(*[F.approx_count_distinct(c) for c in columns]).first()
    return {c: {"total_rows": row["total_rows"], **{n: row[f"{n}_{i}"] for n in statistics}, "about": about[i]} for i, c in enumerate(columns)}


def distinct_counts(df: DataFrame, about: dict[str, dict]) -> DataFrame:
    """(column_name, distinct_count), exact. `about` tells for each column its sketch's count and greatest length.

    Columns with few values share one aggregate, which holds their sets; each other column is
    counted by a scan of its own that reads nothing else. No row is expanded.
    """
    few = [c for c, x in about.items() if x["about"] <= FEW]
    parts = []
    if few:
        sets = df.agg(*[F.size(F.collect_set(_counted_value(df, c, about[c]["max_length"]))).cast("bigint").alias(f"s{i}") for i, c in enumerate(few)])
        rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("distinct_count")) for i, c in enumerate(few)]
        parts.append(sets.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))  # expands one row of sizes
    for c in about:
        if c not in few:
            values = df.select(_counted_value(df, c, about[c]["max_length"]).alias("value")).distinct()
            parts.append(values.agg(F.count("value").alias("distinct_count")).select(F.lit(c).alias("column_name"), "distinct_count"))
    return reduce(DataFrame.union, parts)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, NULLs, empty or blank, blank-only, distinct values, length range, percentages.

    Two wide aggregates run at once, one of them sketches the distinct values; they decide how these are counted.
    """
    columns = list(columns or df.columns)
    about = _wide_statistics(df, columns)
    schema = "column_name string, total_rows bigint, null_count bigint, empty_count bigint, blank_count bigint, min_length int, max_length int"
    names = [x.split()[0] for x in schema.split(", ")][1:]
    known = [(c, *[about[c][n] for n in names]) for c in columns if about[c]["total_rows"]]
    stats = df.sparkSession.createDataFrame(known, schema)
    return stats.join(F.broadcast(distinct_counts(df, about)), "column_name").select(  # one row per profiled column on both sides
        "column_name", "total_rows", "null_count", "empty_count", "blank_count", "distinct_count", "min_length", "max_length",
        percent(F.col("null_count"), F.col("total_rows")).alias("null_pct"),
        percent(F.col("distinct_count"), F.col("total_rows")).alias("distinct_pct"),
    )


def top_values(df: DataFrame, columns: Sequence[str], max_distinct: int = 35, top: int = 10) -> DataFrame:
    """Most frequent values (NULL included) of columns with few distinct values; ties by value.

    One aggregate of sketches leaves out the columns that cannot qualify; each of the others is counted
    by a scan of its own, one row per value and task.
    """
    row = df.agg(*[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    # the sketch errs by some percent; twice the limit is far beyond
    parts = [df.select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")).groupBy("column_name", "value").agg(F.count("*").alias("n"))
             for i, c in enumerate(columns) if row[f"d{i}"] <= 2 * max_distinct]
    empty = df.sparkSession.createDataFrame([], "column_name string, value string, n bigint")
    shown = reduce(DataFrame.union, parts, empty)
    of_column = W.partitionBy("column_name")  # at most some 2 * max_distinct rows per column
    few = shown.withColumn("__d", F.count("value").over(of_column)).filter(F.col("__d") <= max_distinct)
    few = few.select("column_name", F.coalesce(F.col("value"), F.lit(CONCAT_NULL)).alias("value"), "n")
    rank = F.row_number().over(of_column.orderBy(F.desc("n"), F.asc("value")))
    return few.withColumn("rank", rank).filter(F.col("rank") <= top)


def key_collisions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidate key test: repeated groups, rows in them, largest multiplicity (1 when unique)."""
    return repeated_keys(df, keys).agg(
        F.count("*").alias("collision_groups"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("collision_rows"),
        F.coalesce(F.max("n_rows"), F.lit(1)).alias("max_multiplicity"),
    ).withColumn("is_unique", F.col("collision_groups") == 0)


def composite_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows against distinct key tuples, both as tuples (NULL-safe) and as concatenated text."""
    tuples = df.select(*keys).groupBy(*keys).agg(F.count("*").alias("n"))
    return tuples.select("n", concat_key(*keys).alias("__text")).groupBy("__text").agg(
        F.sum("n").alias("n"), F.count("*").alias("tuples")
    ).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("tuples"), F.lit(0)).alias("distinct_tuples"),
        F.count("*").alias("distinct_texts"),
    )


def _tuples(df: DataFrame, keys: Sequence[str], attributes: Sequence[str], null_keys: bool) -> DataFrame:
    rows = df.select(*keys, *attributes)
    if not null_keys:
        for k in keys:
            rows = rows.filter(F.col(k).isNotNull())
    return rows.distinct()


def tuple_dependency(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str], null_keys: bool = False
) -> DataFrame:
    """key -> (all attributes): keys with exactly one and with several distinct tuples."""
    per_key = key_counts(_tuples(df, keys, attributes, null_keys), keys, "n")
    return per_key.agg(
        F.count("*").alias("total_keys"),
        F.count_if(F.col("n") == 1).alias("single_keys"),
        F.count_if(F.col("n") > 1).alias("multiple_keys"),
        F.max("n").alias("max_tuples"),
    ).withColumn(
        "multiple_pct",
        F.coalesce(F.round(F.try_divide(F.col("multiple_keys"), F.col("total_keys")) * 100.0, 4), F.lit(0.0)),
    )


def dependency(
    df: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    null_is_value: bool = True,
    null_keys: bool = False,
    digits: int = 4,
) -> DataFrame:
    """key -> attribute, for many attributes at once: keys with several values, and the most values.

    One aggregate by key, of numbers only, tells for every attribute whether it varies under a key: text is
    stood for by two 64-bit hashes, so no text is sorted or held. Only attributes that vary somewhere
    go on, each by the distinct (key, value) pairs of a scan that reads nothing else. Rows are neither
    expanded nor joined back. The first aggregate runs at once.
    """
    rows = df.select(*keys, *attributes)
    if not null_keys:
        for k in keys:
            rows = rows.filter(F.col(k).isNotNull())

    def compact(a: str) -> list[Column]:
        if isinstance(df.schema[a].dataType, (T.NumericType, T.DateType, T.BooleanType, T.TimestampType)):
            return [F.col(a)]
        return [F.when(F.col(a).isNotNull(), F.xxhash64(*seed, F.col(a).cast("string"))) for seed in ([], [F.lit(1)])]

    def varies(a: str) -> Column:
        several = reduce(lambda x, y: x | y, [F.coalesce(F.min(v) != F.max(v), F.lit(False)) for v in compact(a)])
        return several | ((F.count(a) > 0) & (F.count(a) < F.count("*"))) if null_is_value else several

    per_key = rows.groupBy(*keys).agg(
        *[varies(a).cast("int").alias(f"v{i}") for i, a in enumerate(attributes)], *[(F.count(a) > 0).cast("int").alias(f"h{i}") for i, a in enumerate(attributes)])
    wide = per_key.agg(F.count("*").alias("total"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(len(attributes))], *[F.max(f"h{i}").alias(f"h{i}") for i in range(len(attributes))]).first()
    total = wide["total"]
    # values an attribute shows per key when none varies: 1, or 0 where NULL is no value and all are NULL
    known = [(a, total, total - (wide[f"v{i}"] or 0), wide[f"v{i}"] or 0, (1 if total else None) if null_is_value else wide[f"h{i}"]) for i, a in enumerate(attributes)]
    totals = df.sparkSession.createDataFrame(known, "column_name string, total_keys bigint, single_keys bigint, multiple_keys bigint, __base bigint")
    counted = F.count("*") if null_is_value else F.count("value")
    parts = [
        rows.select(*keys, value_key(F.col(a).cast("string")).alias("value")).distinct().groupBy(*keys).agg(counted.alias("n")).agg(F.max("n").alias("__max")).select(F.lit(a).alias("column_name"), "__max")
        for a, *_, multiple, _ in known if multiple
    ]
    most = reduce(DataFrame.union, parts, df.sparkSession.createDataFrame([], "column_name string, __max bigint"))
    result = totals.join(F.broadcast(most), "column_name", "left").select(  # one row per attribute on both sides
        "column_name", "total_keys", "single_keys", "multiple_keys", F.greatest(F.col("__base"), F.col("__max")).alias("max_values"))
    pct = F.round(F.try_divide(F.col("multiple_keys"), F.col("total_keys")) * 100.0, digits)
    return result.withColumn("multiple_pct", F.coalesce(pct, F.lit(0.0)))


def column_stability(df: DataFrame, keys: Sequence[str], columns: Sequence[str], may_vary: Sequence[str]) -> DataFrame:
    """Stable or varying per key for every column, and whether only the allowed columns vary."""
    found = dependency(df, keys, columns, null_is_value=True, null_keys=True, digits=6)
    varies = F.col("multiple_keys") > 0
    return found.select(
        "column_name", "multiple_keys", "multiple_pct", "max_values",
        F.when(varies, "VARIES").otherwise("STABLE").alias("status"),
        (~varies | F.col("column_name").isin(list(may_vary))).alias("allowed"),
    )


def worst_offenders(df: DataFrame, keys: Sequence[str], attribute: str, top: int = 5) -> DataFrame:
    """Keys with the most distinct values of one attribute, NULL counted as a value."""
    pairs = _tuples(df, keys, [attribute], False)
    return (
        key_counts(pairs, keys, "distinct_values")
        .filter(F.col("distinct_values") > 1)
        .orderBy(F.desc("distinct_values"), *[F.asc(k) for k in keys])
        .limit(top)
    )


def duplicate_census(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return repeated_keys(df, keys).orderBy(F.desc("n_rows"), *[F.asc(k) for k in keys])


def conflict_census(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys, keys seen more than once, rows of those, rows seen once."""
    n = F.col("n_rows")
    zero = F.lit(0).cast("bigint")
    return key_counts(df, [key]).agg(
        F.count(key).alias("distinct_keys"),
        F.count_if(n > 1).alias("conflict_keys"),
        F.coalesce(F.sum(F.when(n > 1, n)), zero).alias("conflict_rows"),
        F.count_if(n == 1).alias("clean_rows"),
    )


def flagged_census(df: DataFrame, key: str, count_column: str, flag_column: str) -> DataFrame:
    """The same census read from stored conflict columns, plus rows where count and flag disagree."""
    count, flag = F.col(count_column), F.col(flag_column)
    per_key = df.groupBy(key).agg(
        F.count_if(count > 1).alias("__conflict"), F.count_if(flag).alias("__flagged"),
        F.count_if(~flag).alias("__clean"), F.count_if((count > 1) != flag).alias("__odd"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("bigint"))
    return per_key.agg(
        F.count(key).alias("distinct_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("__conflict") > 0)).alias("conflict_keys"),
        total("__conflict").alias("conflict_rows"),
        total("__flagged").alias("flagged_rows"),
        total("__clean").alias("clean_rows"),
        total("__odd").alias("inconsistent_rows"),
    )


def pair_differences(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """For keys with exactly two rows: each column in which the two differ, with both values as text."""
    twice = key_counts(df, [key]).filter(F.col("n_rows") == 2).select(F.col(key).alias("__key"))
    rows = df.select(key, *columns).join(twice, F.col(key).eqNullSafe(F.col("__key")), "left_semi")
    compared = as_pairs(rows, columns, [key]).groupBy(key, "column_name").agg(
        F.count("value").alias("__present"),
        F.min("value").alias("value_low"),
        F.max("value").alias("value_high"),
    )
    one_null = F.col("__present") == 1
    return compared.filter(one_null | (F.col("value_low") != F.col("value_high"))).select(
        key, "column_name",
        F.when(one_null, F.lit(None).cast("string")).otherwise(F.col("value_low")).alias("value_low"),
        "value_high",
    )


def pair_summary(df: DataFrame, key: str, columns: Sequence[str], lineage: Sequence[str], expected: str) -> DataFrame:
    """Per two-row key: differing columns, whether only the expected one differs, whether lineage agrees."""
    differences = pair_differences(df, key, [*columns, *lineage])
    pairs = key_counts(df, [key]).filter(F.col("n_rows") == 2).select(key)
    is_lineage = F.col("column_name").isin(list(lineage))
    per_key = differences.groupBy(key).agg(
        F.count_if(~is_lineage).alias("n_columns"),
        F.count_if(F.col("column_name") == expected).alias("__expected"),
        F.count_if(is_lineage).alias("__lineage"),
    )
    renamed = per_key.withColumnRenamed(key, "__key")
    zero = F.lit(0).cast("bigint")
    return pairs.join(renamed, F.col(key).eqNullSafe(F.col("__key")), "left").select(
        key,
        F.coalesce(F.col("n_columns"), zero).alias("n_columns"),
        (F.coalesce((F.col("n_columns") == 1) & (F.col("__expected") == 1), F.lit(False))).alias("only_expected"),
        (F.coalesce(F.col("__lineage"), zero) == 0).alias("same_lineage"),
    )


def date_profile(df: DataFrame, columns: Sequence[str], first_year: int = 1990, last_year: int = 2050) -> DataFrame:
    """Per date column: NULLs, range, distinct years, rows before and after the window. One scan."""
    counts = as_pairs(df, columns, cast="date").groupBy("column_name", "value").agg(F.count("*").alias("n"))
    year, n = F.year("value"), F.col("n")
    # a date column holds few distinct days, so the second step works on a small table
    by_year = counts.groupBy("column_name", year.alias("__year")).agg(
        F.sum(n).alias("n"), F.min("value").alias("first"), F.max("value").alias("last")
    )
    zero = F.lit(0).cast("bigint")
    where = lambda condition: F.coalesce(F.sum(F.when(condition, n)), zero)
    return by_year.groupBy("column_name").agg(
        F.sum(n).alias("total_rows"),
        where(F.col("__year").isNull()).alias("null_count"),
        F.min("first").alias("min_date"),
        F.max("last").alias("max_date"),
        F.count("__year").alias("distinct_years"),
        where(F.col("__year") < first_year).alias("before_window"),
        where(F.col("__year") > last_year).alias("after_window"),
    ).withColumn("null_pct", F.round(F.col("null_count") / F.col("total_rows") * 100.0, 4))


def date_anomalies(
    df: DataFrame, columns: Sequence[str], first_year: int = 1990, last_year: int = 2050, top: int = 5
) -> DataFrame:
    """The first few distinct dates outside the window, per column."""
    days = as_pairs(df, columns, cast="date").filter(
        (F.year("value") < first_year) | (F.year("value") > last_year)
    ).distinct()
    rank = F.row_number().over(W.partitionBy("column_name").orderBy("value"))
    return days.withColumn("rank", rank).filter(F.col("rank") <= top)


def lineage_profile(df: DataFrame, run: str, sha: str, at: str) -> DataFrame:
    """Rows, distinct runs and source hashes, and the range of each lineage column."""
    grouped = df.groupBy(run, sha).agg(F.count("*").alias("n"), F.min(at).alias("lo"), F.max(at).alias("hi"))
    return grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count_distinct(run).alias("distinct_runs"), F.min(run).alias("min_run"), F.max(run).alias("max_run"),
        F.count_distinct(sha).alias("distinct_sha256"), F.min(sha).alias("min_sha256"), F.max(sha).alias("max_sha256"),
        F.min("lo").alias("min_ingested"), F.max("hi").alias("max_ingested"),
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and NULLs per column, one scan."""
    counts = df.agg(F.count("*").alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot(["total_rows"], list(columns), "column_name", "null_count").select(
        "column_name", "total_rows", "null_count"
    )


def describe_columns(df: DataFrame, technical: Sequence[str]) -> DataFrame:
    """Schema as rows: position, name, type and whether the column is technical."""
    rows = [(i, f.name, f.dataType.simpleString(), f.name in technical) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, is_technical boolean")
