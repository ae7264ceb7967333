"""Connected components of a link table, without gathering links or components anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import forget, stored


def forest(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its tree) for the nodes of an (n, 2) array, roots left out."""
    nodes, flat = np.unique(pairs, return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in flat.reshape(-1, 2).tolist():
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    top = np.array([root(x) for x in range(len(nodes))], np.int64)
    rest = np.flatnonzero(top != np.arange(len(nodes)))
    return nodes[rest], nodes[top[rest]]


def _local_forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = forest(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], 1)) if batch.num_rows else (np.zeros(0, np.int64),) * 2
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node; component is the smallest node reachable.

    `links` has two long columns; order and repeats don't matter. Alternates the large-star and the
    small-star step until nothing changes, which takes about log(longest path) rounds. Each round is
    two aggregations with map-side minima and two joins whose hot side adaptive execution may split
    (the other side has one row per node). Each batch of links is first thinned to a forest. NULLs
    and self-links are ignored; no links give no rows.
    """
    a, b = links.columns[:2]
    edges = stored(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").mapInArrow(_local_forests, "a long, b long").distinct(),
        "links",
    )
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.least(F.col("u"), F.min("b")).alias("m"))
        large = both.withColumnRenamed("a", "u").join(low, "u").filter("b > u").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        joined = large.withColumnRenamed("a", "u").join(least, "u")
        small = joined.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        after = stored(small, "links")
        same = edges.exceptAll(after).isEmpty() and after.exceptAll(edges).isEmpty()
        forget(edges)
        edges = after
        if same:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
