"""Join analysis: orphans, coverage, overlap, fan-out and exact post-join totals without the join.

Both sides are reduced to one row per key before they meet, so neither a hot key nor a
many-to-many explosion reaches a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.functions.numbers import MULTIPLICITY_TYPE, SUM_TYPE
from estrato.operators.skew import key_counts


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child keys with no parent, and how many child rows carry each."""
    keys = key_counts(child.filter(F.col(column).isNotNull()), [column])
    # distinct and anti-join share one hash partitioning, and a hot parent key becomes one row
    parents = parent.select(F.col(parent_column).alias(column)).distinct()
    return keys.join(parents, column, "left_anti")


def without(keys: DataFrame, column: str, known: Sequence) -> DataFrame:
    """Keys outside a short list of known exceptions. NULL keys are kept, unlike SQL ``NOT IN``."""
    return keys.filter(~F.coalesce(F.col(column).isin(list(known)), F.lit(False))) if known else keys


def unlinked_rows(parent: DataFrame, column: str, links: DataFrame, link_column: str) -> DataFrame:
    """Parent rows that no link row mentions; NULL keys never match and so are unlinked."""
    return parent.join(links.select(F.col(link_column).alias(column)).distinct(), column, "left_anti")


def key_coverage(left: DataFrame, column: str, right: DataFrame, right_column: str) -> DataFrame:
    """Distinct non-NULL keys of the left side: all, found on the right, not found."""
    keys = left.select(column).filter(F.col(column).isNotNull()).distinct()
    found = right.select(F.col(right_column).alias(column)).distinct().withColumn("__found", F.lit(True))
    return keys.join(found, column, "left").agg(
        F.count("*").alias("total_keys"),
        F.count("__found").alias("matched_keys"),
        (F.count("*") - F.count("__found")).alias("unmatched_keys"),
    )


def key_overlap(sets: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Sizes of all pairwise intersections of several key sets (a set with itself gives its size).

    One shuffle by key marks the sets each key belongs to; no set is joined to another.
    """
    names = list(sets)
    marked: DataFrame | None = None
    for name, (df, column) in sets.items():
        part = df.select(F.col(column).cast("string").alias("key")).filter(F.col("key").isNotNull()).distinct()
        part = part.select("key", *[F.lit(name == n).alias(f"in_{i}") for i, n in enumerate(names)])
        marked = part if marked is None else marked.unionByName(part)
    members = marked.groupBy("key").agg(*[F.bool_or(f"in_{i}").alias(f"in_{i}") for i in range(len(names))])
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sizes = members.agg(
        *[F.count_if(F.col(f"in_{i}") & F.col(f"in_{j}")).alias(f"n_{i}_{j}") for i, j in pairs]
    )
    rows = [
        F.struct(
            F.lit(names[i]).alias("left_set"), F.lit(names[j]).alias("right_set"),
            F.col(f"n_{i}_{j}").alias("n_common"),
        )
        for i, j in pairs
    ]
    return sizes.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def label_conflicts(
    roles: Mapping[str, tuple[DataFrame, str, str]], pairs: Sequence[tuple[str, str]]
) -> DataFrame:
    """Codes described differently by two roles: one row per (code, pair of roles).

    ``n_conflicts`` is the number of (description, other description) combinations that differ,
    worked out from set sizes (n_a * n_b - common); the combinations themselves are never built.
    """
    described: DataFrame | None = None
    for name, (df, code, label) in roles.items():
        part = df.select(F.col(code).alias("code"), F.col(label).alias("label")).filter(
            F.col("code").isNotNull() & F.col("label").isNotNull()
        ).distinct().withColumn("role", F.lit(name))
        described = part if described is None else described.unionByName(part)
    held = described.groupBy("code", "label").agg(
        *[F.bool_or(F.col("role") == n).alias(f"has_{i}") for i, n in enumerate(roles)]
    )
    index = {n: i for i, n in enumerate(roles)}
    aggregates = []
    for a, b in pairs:
        i, j = index[a], index[b]
        aggregates += [
            F.count_if(f"has_{i}").alias(f"n_{i}"),
            F.count_if(f"has_{j}").alias(f"n_{j}"),
            F.count_if(F.col(f"has_{i}") & F.col(f"has_{j}")).alias(f"c_{i}_{j}"),
        ]
    unique = list({a._jc.toString(): a for a in aggregates}.values())
    counts = held.groupBy("code").agg(*unique)
    rows = []
    for a, b in pairs:
        i, j = index[a], index[b]
        rows.append(
            F.struct(
                F.lit(f"{a}_vs_{b}").alias("pair"),
                F.col(f"n_{i}").alias("n_labels_a"),
                F.col(f"n_{j}").alias("n_labels_b"),
                (F.col(f"n_{i}") * F.col(f"n_{j}") - F.col(f"c_{i}_{j}")).alias("n_conflicts"),
            )
        )
    return (
        counts.select("code", F.explode(F.array(*rows)).alias("r"))
        .select("code", "r.*")
        .filter(F.col("n_conflicts") > 0)
    )


def link_multiplicity(links: DataFrame, key: str, member: str | None = None, weights: DataFrame | None = None,
                      weight_key: str | None = None, weight: str = "n_rows") -> DataFrame:
    """Per key, how many rows a join through ``links`` would produce.

    With ``weights`` (one row per ``weight_key``) each link counts as often as its member repeats
    further along, which chains two joins. With ``member`` alone, distinct members are counted.
    """
    if weights is not None:
        per_link = links.groupBy(key, weight_key).agg(F.count("*").alias("__links"))
        return per_link.join(weights, weight_key).groupBy(key).agg(
            F.sum(F.col("__links") * F.col(weight)).alias("multiplicity")
        )
    counted = F.count("*") if member is None else F.count_distinct(member)
    return links.groupBy(key).agg(counted.alias("multiplicity"))


def multiplied_totals(fact: DataFrame, key: str, value: Column, multiplicity: DataFrame) -> DataFrame:
    """Row count and exact money total that joining the fact to the links would give.

    The fact is summed per key first, then meets one multiplicity per key: no row is ever repeated.
    """
    per_key = fact.groupBy(key).agg(
        F.count("*").alias("__rows"), F.sum(value.cast(SUM_TYPE)).alias("__value")
    )
    joined = per_key.join(multiplicity, key)
    times = F.col("multiplicity").cast(MULTIPLICITY_TYPE)
    return joined.agg(
        F.sum(F.col("__rows") * F.col("multiplicity")).cast("bigint").alias("n_rows"),
        F.sum((F.col("__value") * times).cast(SUM_TYPE)).cast(SUM_TYPE).alias("total"),
    )


def plain_totals(fact: DataFrame, value: Column) -> DataFrame:
    return fact.agg(
        F.count("*").alias("n_rows"), F.sum(value.cast(SUM_TYPE)).cast(SUM_TYPE).alias("total")
    )


def named_rows(parts: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Stacks small results of equal shape, each under its name."""
    stacked: DataFrame | None = None
    for label, df in parts.items():
        row = df.select(F.lit(label).alias(name), "*")
        stacked = row if stacked is None else stacked.unionByName(row)
    return stacked


def inflation(steps: DataFrame, base: str, name: str = "step") -> DataFrame:
    """Difference and factor of each step's total against the base step; factor NULL on a zero base."""
    reference = steps.filter(F.col(name) == base).select(F.lit(1).alias("__one"), F.col("total").alias("base_total"))
    tagged = steps.withColumn("__one", F.lit(1)).join(reference, "__one").drop("__one")
    ratio = F.try_divide(F.col("total").cast("double"), F.col("base_total").cast("double"))
    return tagged.select(
        name, "n_rows", "total",
        (F.col("total") - F.col("base_total")).cast(SUM_TYPE).alias("difference"),
        F.round(ratio, 6).alias("factor"),
        F.round((ratio - 1) * 100, 6).alias("pct_difference"),
    )


def multiplicity_histogram(
    entities: DataFrame, key: str, value: str, links: DataFrame, link_key: str, member: str
) -> DataFrame:
    """Entities by number of distinct linked members (0 included), with their true and inflated totals."""
    per_key = entities.groupBy(key).agg(
        F.count("*").alias("__n"), F.sum(F.col(value).cast(SUM_TYPE)).alias("__value")
    )
    linked = link_multiplicity(links, link_key, member).withColumnRenamed(link_key, "__key")
    joined = per_key.join(linked, per_key[key] == linked["__key"], "left")
    times = F.coalesce(F.col("multiplicity"), F.lit(0).cast("bigint"))
    return joined.withColumn("n_members", times).groupBy("n_members").agg(
        F.sum("__n").alias("n_entities"),
        F.sum("__value").cast(SUM_TYPE).alias("unique_total"),
        F.sum((F.col("__value") * F.col("n_members").cast(MULTIPLICITY_TYPE)).cast(SUM_TYPE))
        .cast(SUM_TYPE).alias("inflated_total"),
    )


def histogram_summary(histogram: DataFrame) -> DataFrame:
    """Entities without, with one and with several members; inflation over linked entities only."""
    linked = F.col("n_members") > 0
    unique = F.sum(F.when(linked, F.col("unique_total")))
    inflated = F.sum(F.when(linked, F.col("inflated_total")))
    zero = F.lit(0).cast(SUM_TYPE)
    sums = histogram.agg(
        F.coalesce(F.sum(F.when(F.col("n_members") == 0, F.col("n_entities"))), F.lit(0)).alias("without_members"),
        F.coalesce(F.sum(F.when(F.col("n_members") == 1, F.col("n_entities"))), F.lit(0)).alias("one_member"),
        F.coalesce(F.sum(F.when(F.col("n_members") > 1, F.col("n_entities"))), F.lit(0)).alias("several_members"),
        F.max("n_members").alias("max_members"),
        F.coalesce(unique.cast(SUM_TYPE), zero).alias("unique_total"),
        F.coalesce(inflated.cast(SUM_TYPE), zero).alias("inflated_total"),
    )
    factor = F.try_divide(F.col("inflated_total").cast("double"), F.col("unique_total").cast("double"))
    return sums.withColumns({
        "difference": (F.col("inflated_total") - F.col("unique_total")).cast(SUM_TYPE),
        "factor": F.when(F.col("unique_total") > 0, F.round(factor, 6)).otherwise(1.0),
    })


def mapping_audit(
    source: DataFrame, target: DataFrame, key: str, mapped: Mapping[str, Column]
) -> DataFrame:
    """Per derived column: source rows whose recomputed value differs from the stored one (NULL-aware).

    All columns are checked in one join. Source rows are first counted per (key, derived values) and
    target rows brought to one per key, so a key that repeats on both sides is no product. A source
    row without target differs in every column; so does one whose target rows disagree. The join is on
    a struct, which is never NULL: a filter on the target's key alone would keep Spark from working out
    once what source and target are both made of. NULL keys are told apart afterwards.
    """
    expected = source.select(key, *[c.alias(f"__{n}") for n, c in mapped.items()])
    expected = expected.groupBy(*expected.columns).agg(F.count("*").alias("__n"))
    stored = target.groupBy(F.col(key).alias("__key")).agg(
        *[f(n).alias(f"__{m}_{n}") for n in mapped for m, f in (("min", F.min), ("max", F.max))],
        *[F.count_if(F.col(n).isNull()).alias(f"__null_{n}") for n in mapped], F.count("*").alias("__rows"),
    )
    joined = expected.join(stored, F.struct(expected[key].alias("k")) == F.struct(stored["__key"].alias("k")), "left")

    def differs(n: str) -> Column:
        value, nulls = F.col(f"__{n}"), F.col(f"__null_{n}")
        same = F.when(expected[key].isNull(), False).when(value.isNull(), nulls == F.col("__rows")).otherwise(
            (nulls == 0) & (value == F.col(f"__min_{n}")) & (value == F.col(f"__max_{n}")))
        return ~F.coalesce(same, F.lit(False))

    differing = joined.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("checked_rows"),
        *[F.coalesce(F.sum(F.when(differs(n), F.col("__n"))), F.lit(0)).alias(n) for n in mapped],
    )
    return differing.unpivot(["checked_rows"], list(mapped), "column_name", "n_different").select(
        "column_name", "checked_rows", "n_different"
    )


def sentinel_key_audit(
    fact: DataFrame, columns: Sequence[str], dimension: DataFrame, key: str, missing: int = -1, outside: int = -2
) -> DataFrame:
    """Per foreign key into a calendar: rows, rows without a match, rows on each sentinel. One scan.

    Rows are counted per (column, key value) first, so the join sees each distinct value once.
    """
    long = fact.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])).alias("r")
    ).select("r.*")
    counts = long.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    known = dimension.select(F.col(key).alias("__known")).distinct()
    joined = counts.join(known, counts["value"] == known["__known"], "left")
    zero = F.lit(0).cast("bigint")
    summed = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), zero)
    return joined.groupBy("column_name").agg(
        F.sum("n").alias("total_rows"),
        summed(F.col("__known").isNull()).alias("orphan_rows"),
        summed(F.col("value") == missing).alias("missing_rows"),
        summed(F.col("value") == outside).alias("outside_rows"),
    )
