"""Declared constraints, comparisons between layers, and gates.

Checks return small DataFrames. A comparison is a pair of long (item, value) tables matched by
item, so any number of counts and sums of one table costs one scan of it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.functions import exact_sum
from estrato.functions.numbers import SUM_TYPE
from estrato.operators.skew import repeated_keys
from estrato.session import kept

PASS, FAIL = "PASS", "FAIL"


# ---- rows that break a rule ------------------------------------------------------------------------

def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted_rows(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose non-NULL value is outside the list."""
    return df.filter(~F.col(column).isin(list(values)))


def duplicate_keys(df: DataFrame, keys: Sequence[str], null_keys: bool = True) -> DataFrame:
    """Keys on more than one row. Single-column uniqueness ignores NULL, composite keys count it."""
    rows = df if null_keys else reduce(lambda d, k: d.filter(F.col(k).isNotNull()), keys, df)
    return repeated_keys(rows, keys)


def inconsistent_flags(df: DataFrame, count_column: str, flag_column: str) -> DataFrame:
    return df.filter((F.col(count_column) > 1) != F.col(flag_column))


def inconsistent_presence(df: DataFrame, flag_column: str, key_column: str) -> DataFrame:
    return df.filter(F.col(flag_column) != F.col(key_column).isNotNull())


def unstable_keys(df: DataFrame, key: str, stable_columns: Sequence[str]) -> DataFrame:
    """Keys whose stable columns take more than one tuple."""
    return repeated_keys(df.select(*stable_columns).distinct(), [key], "n_tuples")


def forbidden_columns(df: DataFrame, forbidden: Sequence[str]) -> list[str]:
    """Columns a table must not have, compared without regard to case."""
    banned = {c.lower() for c in forbidden}
    return [c for c in df.columns if c.lower() in banned]


def calendar_structure(dim: DataFrame, key: str = "data_sk", day: str = "data") -> DataFrame:
    return dim.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col(key) == -1).alias("missing_rows"),
        F.count_if(F.col(key) == -2).alias("outside_rows"),
        F.count_if(F.col(key) > 0).alias("civil_days"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.count_distinct(day).alias("distinct_days"),
    )


# ---- declared contracts ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Contract:
    """What must hold for one table. References are (column, other table, other column)."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    composite_unique: tuple[tuple[str, ...], ...] = ()
    accepted: Mapping[str, tuple] = field(default_factory=dict)
    references: tuple[tuple[str, str, str], ...] = ()


Key = tuple[str, tuple[str, ...]]
"""A table and the columns of one of its keys."""


def key_domains(contracts: Mapping[str, Contract]) -> list[list[Key]]:
    """The keys of all contracts, those that a reference relates in one list: they have the same kind of values."""
    keys: dict[Key, None] = {}
    related: list[tuple[Key, Key]] = []
    for name, c in contracts.items():
        keys.update({(name, (u,)): None for u in c.unique} | {(name, tuple(u)): None for u in c.composite_unique})
        for column, other, other_column in c.references:
            related.append(((name, (column,)), (other, (other_column,))))
            keys.update(dict.fromkeys(related[-1]))
    domain = {k: i for i, k in enumerate(keys)}
    for x, y in related:
        old, new = domain[x], domain[y]
        domain = {k: new if i == old else i for k, i in domain.items()}
    return [[k for k in keys if domain[k] == i] for i in dict.fromkeys(domain.values())]


def _key_census(tables: Mapping[str, DataFrame], keys: Sequence[Key], references: Sequence[tuple[Key, Key, str]]) -> DataFrame:
    """Counts of all keys of one domain, from one shuffle of (key, role): a row per rule.

    Each table is read once, and only its keys. A key is one row per task and role in the shuffle, however
    many rows have it. NULL is no key, but one of several columns may be NULL.
    """
    parts = []
    for name in dict.fromkeys(n for n, _ in keys):
        df, own = tables[name], [(i, columns) for i, (n, columns) in enumerate(keys) if n == name]
        integral = all(isinstance(tables[n].schema[c].dataType, T.IntegralType) for n, cs in keys for c in cs)

        def value(columns: Sequence[str]) -> Column:
            typed = [F.col(c).cast("long" if integral else "string") for c in columns]
            return typed[0] if len(typed) == 1 else F.struct(*[v.alias(f"k{j}") for j, v in enumerate(typed)])

        if len(own) == 1:
            rows = df.select(F.lit(own[0][0]).alias("role"), value(own[0][1]).alias("key"))
        else:
            rows = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("role"), value(cs).alias("key")) for i, cs in own])).alias("r")).select("r.*")
        parts.append(rows.filter("key IS NOT NULL"))
    per_key = reduce(DataFrame.union, parts).groupBy("key").agg(*[F.count_if(F.col("role") == i).alias(f"n{i}") for i in range(len(keys))])
    zero = F.lit(0).cast("bigint")
    numbers: list[tuple[str, str, str, Column]] = []
    for i, (name, columns) in enumerate(keys):
        n, target = F.col(f"n{i}"), "+".join(columns)
        numbers += [(name, "unique", target, F.count_if(n > 1)), (name, "distinct", target, F.count_if(n > 0)),
                    (name, "repeated_rows", target, F.coalesce(F.sum(F.when(n > 1, n)), zero))]
    place = {k: i for i, k in enumerate(keys)}
    for child, parent, target in references:
        lost = F.sum(F.when(F.col(f"n{place[parent]}") == 0, F.col(f"n{place[child]}")))
        numbers.append((child[0], "references", target, F.coalesce(lost, zero)))
    return _long_rows(per_key, numbers)


def _long_rows(df: DataFrame, numbers: Sequence[tuple[str, str, str, Column]]) -> DataFrame:
    """(table_name, rule, target, value) of aggregates of one table, in one pass."""
    wide = df.agg(*[c.cast("bigint").alias(f"a{i}") for i, (*_, c) in enumerate(numbers)])
    rows = [F.struct(F.lit(t).alias("table_name"), F.lit(r).alias("rule"), F.lit(x).alias("target"), F.col(f"a{i}").alias("value")) for i, (t, r, x, _) in enumerate(numbers)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def census(tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]) -> DataFrame:
    """(table_name, rule, target, value): all that contracts and key gates of a layer ask for, measured once.

    Rules: rows, nulls of every key and required column, accepted_values, and per key unique (keys on several
    rows), distinct, repeated_rows, references (rows whose key has no parent). A table is worked out once: its
    columns that are counted are stored, then read in one pass, and its keys once more in a shuffle per domain.
    """
    domains = key_domains(contracts)
    parts, held = [], {}
    for name in dict.fromkeys([*contracts, *(n for d in domains for n, _ in d)]):
        c = contracts.get(name, Contract())
        keys = [x for d in domains for n, cs in d if n == name for x in cs]
        needed = dict.fromkeys([*c.not_null, *keys])
        read = dict.fromkeys([*needed, *c.accepted])
        held[name] = kept(tables[name].select(*read), "census") if keys else tables[name]
        numbers = [(name, "rows", "*", F.count("*")), *[(name, "nulls", x, F.count_if(F.col(x).isNull())) for x in needed],
                   *[(name, "accepted_values", x, F.count_if(~F.col(x).isin(list(v)))) for x, v in c.accepted.items()]]
        parts.append(_long_rows(held[name], numbers))
    for keys in domains:
        related = [((n, (c,)), (o, (oc,)), f"{c}->{o}.{oc}") for n, contract in contracts.items() for c, o, oc in contract.references if (n, (c,)) in keys]
        parts.append(_key_census(held, keys, related))
    return reduce(DataFrame.union, parts)


def contract_rows(found: DataFrame, contracts: Mapping[str, Contract]) -> DataFrame:
    """The declared rules among what a census counted: (table_name, rule, target, violations)."""
    declared = [(n, *rule) for n, c in contracts.items() for rule in (
        *(("not_null", x) for x in c.not_null), *(("accepted_values", x) for x in c.accepted), *(("unique", x) for x in c.unique),
        *(("unique", "+".join(x)) for x in c.composite_unique), *(("references", f"{x}->{o}.{y}") for x, o, y in c.references))]
    rules = found.sparkSession.createDataFrame(declared, "table_name string, rule string, target string")
    named = found.withColumn("rule", F.when(F.col("rule") == "nulls", "not_null").otherwise(F.col("rule")))
    return rules.join(named, ["table_name", "rule", "target"], "left").select("table_name", "rule", "target", F.col("value").alias("violations"))


def check_contract(tables: Mapping[str, DataFrame], name: str, contract: Contract) -> DataFrame:
    """One row per declared rule of one table: (table_name, rule, target, violations)."""
    return check_contracts(tables, {name: contract})


def check_contracts(tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]) -> DataFrame:
    return contract_rows(census(tables, contracts), contracts)


def counted(found: DataFrame, items: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """(item, value) of a census by item -> (table_name, rule, target); a number that was not taken is NULL."""
    wanted = found.sparkSession.createDataFrame([(i, *x) for i, x in items.items()], "item string, table_name string, rule string, target string")
    return wanted.join(found, ["table_name", "rule", "target"], "left").select("item", F.col("value").cast(SUM_TYPE).alias("value"))


# ---- measuring and comparing -----------------------------------------------------------------------

def measures(df: DataFrame, items: Mapping[str, Column]) -> DataFrame:
    """(item, value) with every value at decimal(38,2); all items of a table in one scan."""
    names = list(items)
    row = df.agg(*[items[n].cast(SUM_TYPE).alias(f"m{i}") for i, n in enumerate(names)])
    pairs = [F.struct(F.lit(n).alias("item"), F.col(f"m{i}").alias("value")) for i, n in enumerate(names)]
    return row.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def money_measures(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    return measures(df, {item: exact_sum(c) for item, c in columns.items()})


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def compare(gate: str, expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(gate, item, expected, actual, diff, status). A missing or NULL side fails, it never passes."""
    e = expected.select("item", F.col("value").alias("expected"))
    a = actual.select("item", F.col("value").alias("actual"))
    joined = e.join(a, "item", "full_outer")
    diff = (F.col("actual") - F.col("expected")).cast(SUM_TYPE)
    return joined.select(
        F.lit(gate).alias("gate"), "item", "expected", "actual", diff.alias("diff"),
        F.when(diff == 0, PASS).otherwise(FAIL).alias("status"),
    )


def compare_within(gate: str, df: DataFrame, items: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Compares pairs of aggregates of one table, (expected, actual) per item, in one scan."""
    names = list(items)
    sides = [(f"e{i}", items[n][0]) for i, n in enumerate(names)] + [(f"a{i}", items[n][1]) for i, n in enumerate(names)]
    row = df.agg(*[c.cast(SUM_TYPE).alias(alias) for alias, c in sides])
    pairs = [
        F.struct(F.lit(n).alias("item"), F.col(f"e{i}").alias("expected"), F.col(f"a{i}").alias("actual"))
        for i, n in enumerate(names)
    ]
    diff = (F.col("actual") - F.col("expected")).cast(SUM_TYPE)
    return row.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").select(
        F.lit(gate).alias("gate"), "item", "expected", "actual", diff.alias("diff"),
        F.when(diff == 0, PASS).otherwise(FAIL).alias("status"),
    )


def rows_equal_keys(gate: str, df: DataFrame, items: Mapping[str, str]) -> DataFrame:
    """Rows equal distinct non-NULL values, per item -> column: a duplicate or a NULL key fails."""
    return compare_within(gate, df, {i: (F.count_distinct(c), F.count("*")) for i, c in items.items()})


def must_be(gate: str, actual: DataFrame, expected: int | str = 0) -> DataFrame:
    """Compares every item with one constant."""
    return compare(gate, actual.select("item", F.lit(expected).cast(SUM_TYPE).alias("value")), actual)


def row_parity(gate: str, pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Same number of rows on both sides, for several table pairs."""
    count = lambda n, df: measures(df, {n: F.count("*")})
    return compare(
        gate,
        stack([count(n, a) for n, (a, _) in pairs.items()]),
        stack([count(n, b) for n, (_, b) in pairs.items()]),
    )


def key_parity(gate: str, item: str, source: DataFrame, key: str, target: DataFrame) -> DataFrame:
    """Rows of the target equal the distinct non-NULL keys of the source; a NULL row fails it."""
    return compare(
        gate, measures(source, {item: F.count_distinct(key)}), measures(target, {item: F.count("*")})
    )


def with_baseline(gate_rows: DataFrame, baseline: DataFrame) -> DataFrame:
    """Adds stored constants (gate, item, baseline). Items that have one must also equal it."""
    joined = gate_rows.join(baseline, ["gate", "item"], "left")
    broken = F.col("baseline").isNotNull() & ~F.col("actual").eqNullSafe(F.col("baseline"))
    return joined.withColumn("status", F.when(broken, FAIL).otherwise(F.col("status")))


def gate_verdicts(gate_rows: DataFrame) -> DataFrame:
    """One line per gate; a gate fails if any of its items does."""
    return gate_rows.groupBy("gate").agg(
        F.count("*").alias("n_items"),
        F.count_if(F.col("status") != PASS).alias("n_failed"),
        F.when(F.count_if(F.col("status") != PASS) > 0, FAIL).otherwise(PASS).alias("status"),
    )


def run_gates(
    spark: SparkSession, gates: Mapping[str, Callable[[], DataFrame]], parallel: int = 4
) -> tuple[bool, DataFrame]:
    """Runs every gate, turning an exception into a FAIL row. Returns (all passed, all rows).

    A gate yields a handful of summary rows, so collecting them is bounded. Gates are independent
    jobs and run side by side.
    """

    def run_one(name: str):
        try:
            return [tuple(r) for r in gates[name]().select(
                "gate", "item", "expected", "actual", "diff", "status").collect()]
        except Exception as error:  # noqa: BLE001  a broken gate is a failed gate
            return [(name, str(error), None, None, None, FAIL)]

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = [row for found in pool.map(run_one, gates) for row in found]
    schema = f"gate string, item string, expected {SUM_TYPE}, actual {SUM_TYPE}, diff {SUM_TYPE}, status string"
    return all(r[5] == PASS for r in rows), spark.createDataFrame(rows, schema)
