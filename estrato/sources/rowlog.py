"""A small keyed table that is only appended to; readers see the newest row of each key.

An entry is one small file. Every row carries the moment of its entry and the writer, so the newest row
is known whatever order files are read in. Compaction writes the newest rows as a new version of the
base and then drops the entries it has read; until they are gone they change nothing, as their rows
are no newer than the base's.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.sources import snapshots as S

MOMENT, WRITER = "__moment", "__writer"
COMPACT_AT = 200
"""Entries after which an append compacts the log."""


def newest_rows(log: DataFrame, keys: Sequence[str], order: Sequence[str] = (MOMENT, WRITER)) -> DataFrame:
    """The row of each key that is last by ``order``, of equal ones the largest in all columns; the order columns are dropped.

    Aggregated inside the tasks first, so a key with many rows is one row a task.
    """
    row = F.struct(*log.columns)
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], row.alias("tie"))
    return log.groupBy(*keys).agg(F.max_by(row, place).alias("__row")).select("__row.*").drop(*order)


class RowLog:
    def __init__(self, spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str]) -> None:
        self.spark, self.table, self.keys, self.names = spark, table, tuple(keys), schema.names
        # a base of an earlier kind, without the two columns, counts as older than any entry
        self.schema = T.StructType([*schema.fields, T.StructField(MOMENT, T.LongType()), T.StructField(WRITER, T.StringType())])
        self.entries = f"{table}/_entries"
        self.writer, self.last = uuid.uuid4().hex, 0
        S.ensure_table(spark, table, self.schema)

    def _all(self) -> DataFrame:
        base = S.read_snapshot(self.spark, self.table)
        if not S.path_exists(self.spark, self.entries):
            return base.unionByName(self.spark.createDataFrame([], self.schema), allowMissingColumns=True)
        entries = self.spark.read.schema(self.schema).parquet(self.entries)
        return base.unionByName(entries, allowMissingColumns=True)

    def read(self) -> DataFrame:
        return newest_rows(self._all(), self.keys).select(*self.names)

    def append(self, rows: DataFrame) -> None:
        """Adds the rows as one entry: rows of the same key read so far are history from here on."""
        self.last = max(self.last + 1, time.time_ns())
        marked = rows.select(*self.names).withColumns({MOMENT: F.lit(self.last), WRITER: F.lit(self.writer)})
        marked.coalesce(1).write.mode("append").parquet(self.entries)
        if len(self._files()) >= COMPACT_AT:
            self.compact()

    def compact(self) -> None:
        """Writes the newest rows as the base and drops the entries they were read from; answers stay the same."""
        read = self._files()
        newest = newest_rows(self._all().withColumns({"__m": F.col(MOMENT), "__w": F.col(WRITER)}), self.keys)
        kept = newest.withColumnsRenamed({"__m": MOMENT, "__w": WRITER}).select(*self.schema.names)
        S.overwrite_snapshot(self.spark, kept, self.table, rebalance=True)
        for name in read:  # at most some COMPACT_AT names
            S.delete_exact(self.spark, f"{self.entries}/{name}", self.entries)

    def _files(self) -> list[str]:
        fs, path = S._fs(self.spark, self.entries)
        return [f.getPath().getName() for f in fs.listStatus(path) if f.getPath().getName().endswith(".parquet")] if fs.exists(path) else []
