"""Repeated runs of lines: a suffix array over line ids by prefix doubling, later copies deleted.

Lines that occur once cannot be part of a repeated run and leave at once. The others get the rank of
their line; ranks of runs of 2k lines come from the pairs of ranks k lines apart, sorted over the
whole cluster. Ranks keep the order of the run's lines, so the positions of a rank are a stretch of
the suffix array, and all suffixes in it have at least 2k lines in common: an interval of the
longest-common-prefix array. Only positions whose interval has several members go on to the next
doubling, and it ends when no run of that length is repeated, so the last interval that a position is
in gives its longest repeated run, to the next power of two; overlapping ones add up to the maximal
runs. Every position that is not its interval's first, by doc_id and line, starts a later copy.

Ranks are row numbers of a globally sorted table of distinct pairs, so a line or passage in a third
of all documents is one row there, and the join that hands ranks out has one row per rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estrato.llm.common import covered, forget, stored

LEAST_LINES = 2
_BLANK = "\t\r\x0b\x0c"


def line_table(docs: DataFrame) -> DataFrame:
    """(d, doc_id, th, lines): distinct (doc_id, text) in order of doc_id; lines are 128-bit hashes of the non-blank ones."""
    text = F.col("text").cast("string")
    filled = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(F.translate(x, _BLANK, " " * len(_BLANK)))) > 0)
    lines = F.transform(filled, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(x, F.lit(1)).alias("b")))
    rows = docs.filter(text.isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), lines.alias("lines"))
    once = rows.groupBy("doc_id", "th").agg(F.first("lines").alias("lines"))
    return stored(once.orderBy(F.asc_nulls_last("doc_id"), "th").withColumn("d", F.monotonically_increasing_id()), "lines")


def _ranked(pairs: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(positions with the rank of their key and the key's first position, ranks): keys that occur once are left out."""
    repeated = pairs.groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.struct("d", "i")).alias("first")).filter("n > 1")
    ranks = stored(repeated.orderBy(*keys).withColumn("r", F.monotonically_increasing_id()), "ranks")
    return stored(pairs.select("d", "i", *[F.col(k).alias(f"_{k}") for k in keys]).join(
        ranks.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("r"), "first"), [f"_{k}" for k in keys]).select("d", "i", "r", "first"), "positions"), ranks


def later_runs(lines: DataFrame, least: int = LEAST_LINES) -> DataFrame:
    """(d, runs): per document the runs (i, k) of k lines from line i that occur before, k a power of two."""
    if least < 1 or least & (least - 1):
        raise ValueError("least must be a power of two")
    flat = lines.select("d", F.posexplode("lines").alias("i", "line")).select("d", "i", "line.a", "line.b")
    positions, ranks = _ranked(flat, ["a", "b"])
    found, k = [], 1
    while True:
        forget(ranks)
        if k >= least:
            found.append(positions.filter(F.col("first") < F.struct("d", "i")).select("d", "i", F.lit(k).alias("k")))
        if positions.isEmpty():
            break
        ahead = F.max("r").over(Window.partitionBy("d").orderBy("i").rangeBetween(k, k))
        pairs = positions.select("d", "i", "r", ahead.alias("next")).filter("next is not null").withColumnRenamed("r", "here")
        positions, ranks = _ranked(pairs, ["here", "next"])
        k *= 2
    runs = found[0] if found else positions.select("d", "i", F.lit(k).alias("k")).limit(0)
    for more in found[1:]:
        runs = runs.union(more)
    longest = runs.groupBy("d", "i").agg(F.max("k").alias("k"))
    return longest.groupBy("d").agg(F.collect_list(F.struct("i", "k")).alias("runs"))


def without(text: str, runs: list[dict]) -> tuple[str, int, int]:
    """(text without the runs' lines, non-blank lines, removed lines). A blank line goes with the lines around it."""
    lines = text.split("\n")
    filled = np.array([bool(x.strip(" " + _BLANK)) for x in lines])
    n = int(filled.sum())
    if not runs:
        return text, n, 0
    gone = np.zeros(n, bool)
    by_length: dict[int, list[int]] = {}
    for run in runs:
        by_length.setdefault(run["k"], []).append(run["i"])
    for k, starts in by_length.items():
        gone |= covered(n, np.array(starts), k)
    before = np.cumsum(filled) - 1  # of a blank line: the last filled line before it
    edge = np.concatenate((gone, [True]))  # beyond either end nothing is kept
    drop = np.where(filled, edge[before], edge[before] & edge[np.minimum(before + 1, n)])
    return "\n".join(x for x, d in zip(lines, drop) if not d), n, int(gone.sum())


def without_later_copies(docs: DataFrame, least: int = LEAST_LINES) -> DataFrame:
    """`docs` (doc_id, text and any other columns) with text changed and n_lines and n_removed added.

    Runs of at least `least` (a power of two) non-blank lines that occur before, in a smaller doc_id or
    earlier in the same text, are deleted; lines are compared as they are. Rows with equal doc_id and
    text count as one document and are treated alike; of different texts with one doc_id the one with
    the smaller hash comes first; NULL ids come last. NULL stays NULL with no lines. Blank lines are no
    part of runs. Added columns replace columns of the same names. An empty table gives an empty result.
    """
    docs = docs.drop("n_lines", "n_removed")
    lines = line_table(docs)
    runs = later_runs(lines, least).join(lines.select("d", "doc_id", "th"), "d").select(F.col("doc_id").alias("__doc"), F.col("th").alias("__th"), F.col("runs").alias("__runs"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.col("doc_id").isNull(), F.xxhash64(F.col("text").cast("string"))
    left = docs.select("*", key[0].alias("__a"), key[1].alias("__b"), key[2].alias("__c"))
    right = runs.select(F.coalesce("__doc", F.lit(0)).alias("__a"), F.col("__doc").isNull().alias("__b"), F.col("__th").alias("__c"), "__runs")
    joined = left.join(right, ["__a", "__b", "__c"], "left").select(*[left[c] for c in docs.columns], "__runs")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            found = [(None, 0, 0) if t is None else without(t, runs or []) for t, runs in zip(batch.column("text").cast(pa.string()).to_pylist(), batch.column("__runs").to_pylist())]
            texts, n, gone = zip(*found) if found else ((), (), ())
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names if c != "__runs"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), pa.array(gone, pa.int64())], [*(c for c in names if c != "__runs"), "n_lines", "n_removed"])

    fields = [f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema]
    return joined.mapInArrow(apply, ", ".join([*fields, "n_lines long", "n_removed long"]))
