"""Counting and joining by key without ever gathering the rows of one key.

A key may hold a third of all rows. Everything here first reduces to one row per key with
map-side partial aggregation, so a hot key costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def repeated_keys(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their multiplicity. NULL is a key value like any other."""
    return key_counts(df, keys, name).filter(F.col(name) > 1)


def null_safe_match(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Equality of several column pairs where NULL matches NULL."""
    condition: Column | None = None
    for a, b in pairs:
        term = left[a].eqNullSafe(right[b])
        condition = term if condition is None else condition & term
    return condition


def with_group_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Adds the number of rows that share the row's key; rows with a NULL key form one group.

    Same result as ``count(*) over (partition by keys)``, which would sort whole rows of one key
    in one task. Here only keys travel: one pruned scan counts them, and only keys seen more than
    once come back, in a join that adaptive execution broadcasts when they are few and splits
    when one is hot. The key is one struct, in which NULL equals NULL, so that Spark sees that it is
    unique and leaves out counting and join where the number is not asked for.
    """
    key = F.struct(*[F.col(k) for k in keys])
    repeated = repeated_keys(df.select(key.alias("__key")), ["__key"], name)
    joined = df.join(repeated, key == F.col("__key"), "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(1).cast("bigint"))).drop("__key")


def heaviest_keys(df: DataFrame, key: str, top: int = 64) -> DataFrame:
    """The ``top`` most frequent non-NULL keys: a result whose size is bounded by ``top``."""
    return (
        key_counts(df.filter(F.col(key).isNotNull()), [key], "__n")
        .orderBy(F.desc("__n"), F.asc(key))
        .limit(top)
        .select(key)
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str,
    how: str = "left",
    salts: int = 32,
    top: int = 64,
    hot: Mapping | None = None,
) -> DataFrame:
    """Equi-join on ``key`` where the left side may hold very hot keys; the result is the plain join.

    The heaviest left keys (at most ``top``, so broadcasting them is bounded) are spread over
    ``salts`` sub-keys chosen by a hash of ``spread_by``; only the right rows of those keys are
    repeated. All other keys keep one sub-key. ``hot`` gives the keys and their numbers of sub-keys where
    they are known, as ``hot_keys`` finds them; nothing is counted then. NULL keys match nothing and
    are spread too. Supports inner, left, left_semi and left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join does not support {how!r}")
    if hot is None:
        listed = heaviest_keys(left, key, top).select(F.col(key).alias("__hot"), F.lit(salts).cast("bigint").alias("__n"))
    else:
        schema = T.StructType([T.StructField("__hot", left.schema[key].dataType), T.StructField("__n", T.LongType())])
        listed = left.sparkSession.createDataFrame(list(hot.items()), schema)
    listed = F.broadcast(listed)
    spread = F.xxhash64(spread_by)
    hot_left = left.join(listed, left[key] == F.col("__hot"), "left").withColumn(
        "__salt", F.when(F.col(key).isNull(), F.pmod(spread, F.lit(salts))).when(F.col("__hot").isNotNull(), F.pmod(spread, F.col("__n"))).otherwise(F.lit(0)),
    ).drop("__hot", "__n")
    sub_keys = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("__n"), F.lit(1)) - 1)
    spread_right = right.join(listed, right[key] == F.col("__hot"), "left").withColumn("__salt", F.explode(sub_keys)).drop("__hot", "__n")
    return hot_left.join(spread_right, [key, "__salt"], how).drop("__salt")


TRACKED = 64
"""Keys a heavy-hitter summary reports at most."""


def heavy_hitters(column: str) -> Column:
    """The most frequent non-NULL values with about their counts: a summary of fixed size that tasks merge.

    An aggregate like any other, so it can be observed while a table is written.
    """
    return F.expr(f"approx_top_k(`{column}`, {TRACKED}, {100 * TRACKED})")


def hot_keys(summary: Sequence, rows: int, tasks: int) -> dict:
    """Key -> number of sub-keys, for keys with over twice an even task's share of the rows."""
    even = max(1.0, rows / max(1, tasks))
    return {x["item"]: -(-x["count"] // int(even)) for x in summary or () if x["count"] > 2 * even}
