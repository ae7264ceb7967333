"""Versioned tables: each write is a whole new version, published by one small marker file.

Layout: every write has a Parquet folder of its own, ``<table>/_v=<n>-<attempt>``, and
``<table>/_published/<n>`` names the one that is version n. Readers only see marked versions, so a
lost executor, a failed write or a second writer leaves the last good version in place. Where the
cluster has a transactional table format, use that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


CLUSTER_PARTS = 2000
"""Parts a clustered write deals values into, so that few values share one; adaptive execution puts small parts together."""


class SnapshotError(RuntimeError):
    """A table cannot be read, or a write does not match what was expected."""


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Errors of the file system are raised, never read as "absent"."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_exact(spark: SparkSession, path: str, inside: str) -> bool:
    """Deletes one file that lies inside the given folder; True when it is gone."""
    plain = lambda s: s.split(":", 1)[-1].replace("///", "/").replace("//", "/")
    if ".." in path.split("/") or not plain(path).startswith(plain(inside).rstrip("/") + "/"):
        raise ValueError(f"{path} is outside {inside}")
    fs, p = _fs(spark, path)
    fs.delete(p, False)
    return not fs.exists(p)


def published_versions(spark: SparkSession, table: str) -> list[int]:
    fs, p = _fs(spark, f"{table}/_published")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def current_version(spark: SparkSession, table: str) -> int | None:
    versions = published_versions(spark, table)
    return versions[-1] if versions else None


def version_path(spark: SparkSession, table: str, version: int) -> str:
    """Folder of a published version, as its marker names it."""
    fs, marker = _fs(spark, f"{table}/_published/{version}")
    if not fs.exists(marker):
        raise SnapshotError(f"{table} has no version {version}")
    jvm = spark._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(marker), "UTF-8"))
    try:
        return f"{table}/{reader.readLine()}"
    finally:
        reader.close()


def _publish(spark: SparkSession, table: str, version: int, folder: str) -> None:
    fs, marker = _fs(spark, f"{table}/_published/{version}")
    try:
        out = fs.create(marker, False)
    except Py4JError as error:  # the marker exists: another writer was first
        raise SnapshotError(f"version {version} of {table} was published by another writer") from error
    out.write(bytearray(folder.encode()))
    out.close()


def _next_version(spark: SparkSession, table: str) -> int:
    """Past every published version and every leftover of a failed write."""
    fs, p = _fs(spark, table)
    if not fs.exists(p):
        return 0
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    used = [int(n[3:].split("-")[0]) for n in found if n.startswith("_v=")]
    return max([*used, *published_versions(spark, table), -1]) + 1


def overwrite_snapshot(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    expected_rows: int | None = None,
    check: Callable[[dict], None] | None = None,
    metrics: dict | None = None,
    drop: Sequence[str] = (),
    rebalance: bool = False,
    cluster: Sequence[str] = (),
) -> int:
    """Writes a new version and publishes it only if the checks pass; returns the version.

    ``metrics`` are aggregates observed while writing, so checks cost no further scan of the
    input. The rows read back from the written files must match what was observed or expected.
    ``drop`` are columns that only the metrics need. ``rebalance`` deals the rows into files of
    even size, ``cluster`` also keeps rows of equal values of these columns together, ordered in
    each file, so that filters on them skip files.
    """
    version = _next_version(spark, table)
    seen = Observation()
    aggregates = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()]]
    # dealt by value, not by ranges: finding those works its input out a second time, and a range can't part one value
    out = df
    if cluster:
        out = out.hint("rebalance", CLUSTER_PARTS, *cluster).sortWithinPartitions(*cluster)
    elif rebalance:
        out = out.hint("rebalance")
    out = out.observe(seen, *aggregates).drop(*drop)
    folder = f"_v={version}-{uuid.uuid4().hex}"
    out.write.mode("errorifexists").parquet(f"{table}/{folder}")
    observed = seen.get
    if check is not None:
        check(observed)
    wanted = observed["rows"] if expected_rows is None else expected_rows
    verify_written(spark, f"{table}/{folder}", wanted)
    _publish(spark, table, version, folder)
    return version


def verify_written(spark: SparkSession, path: str, expected_rows: int) -> int:
    """Counts rows from the written file footers; a difference is an error."""
    found = spark.read.parquet(path).count()
    if found != expected_rows:
        raise SnapshotError(f"{path}: {found} rows were written, {expected_rows} were expected")
    return found


def read_snapshot(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    chosen = current_version(spark, table) if version is None else version
    if chosen is None:
        raise SnapshotError(f"{table} has no published version")
    return spark.read.parquet(version_path(spark, table, chosen))


def ensure_table(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Creates an empty table only where nothing exists. An unreadable one raises and stays as it is."""
    if not path_exists(spark, table):
        overwrite_snapshot(spark, spark.createDataFrame([], schema), table)
        return
    try:
        read_snapshot(spark, table).limit(1).collect()
    except (PySparkException, SnapshotError, Py4JError) as error:
        raise SnapshotError(f"{table} exists but cannot be read; it is left untouched") from error


def materialize(spark: SparkSession, df: DataFrame, table: str, cluster: Sequence[str] = ()) -> DataFrame:
    """Writes a model and continues from the written table, which cuts its lineage."""
    overwrite_snapshot(spark, df, table, cluster=cluster)
    return read_snapshot(spark, table)


def write_report(df: DataFrame, path: str) -> None:
    """JSON lines; decimals become text so that no digit is lost."""
    exact = [
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*exact).write.mode("errorifexists").json(path)
