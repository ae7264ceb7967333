"""Raw files as tables: fingerprints, digests, inventory, and what may be stored or deleted."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.functions import sha256_in_path
from estrato.sources import splitting


def file_digests(spark: SparkSession, glob: str) -> DataFrame:
    """(path, size, sha256) per file, hashed where the file is read: an extra for files of at most 2 GB.

    Whether a source changed is decided by text_fingerprint, which has no such limit.
    """
    return spark.read.format("binaryFile").load(glob).select(
        "path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256")
    )


def text_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """One row (fingerprint): 64 hex digits for the names and contents of all files, of any size.

    Within a file every byte and the order of all lines count; files may be listed in any order. Files
    are read in blocks, and the value is the same however they are cut. No file at all has a value too.
    """
    text = splitting.lines(spark, path).withColumn("name", F.element_at(F.split(splitting.decoded_path("file"), "/"), -1))
    blocks = text.groupBy("file", "name", "size", "block").agg(F.count("*").alias("n"), F.min("at").alias("least"), *splitting.polynomial_sums(F.col("at"), F.col("value")))
    return combined_fingerprint(splitting.file_fingerprints(blocks))


def combined_fingerprint(files: DataFrame) -> DataFrame:
    """One row (fingerprint) for a set of files (name, fingerprint), in whatever order they come."""
    exact = "decimal(38,0)"
    halves = [F.coalesce(F.sum(F.conv(F.substring("fingerprint", 1 + 15 * i, 15), 16, 10).cast(exact)), F.lit(0)).cast("string") for i in range(4)]
    return files.agg(F.sha2(F.concat_ws("|", F.count("*").cast("string"), *halves), 256).alias("fingerprint"))


def digest_findings(digests: DataFrame, expected: DataFrame) -> DataFrame:
    """Digests against expected (path, expected_sha256, NULL for "any"): OK, MISMATCH, UNEXPECTED or EMPTY.

    Spark's file scans leave out files of zero bytes, so an expected file without a digest is
    empty or absent.
    """
    wrong = F.lower("expected_sha256") != F.col("sha256")
    known = expected.select("path", "expected_sha256", F.lit(True).alias("__known"))
    return digests.join(known, "path", "full_outer").withColumn(
        "status",
        F.when(F.col("sha256").isNull(), "EMPTY").when(F.col("__known").isNull(), "UNEXPECTED")
        .when(wrong, "MISMATCH").otherwise("OK"),
    ).drop("__known")


def raw_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(raw_key, dataset_id, sha256, size, modified_at) of ``<folder>/<dataset>/sha256=<hash>/<file>``.

    Only names and sizes are listed; file contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(
        F.col("path").alias("raw_key"),
        F.nullif(F.regexp_extract("path", "/([^/]+)/sha256=[^/]+/[^/]+$", 1), F.lit("")).alias("dataset_id"),
        sha256_in_path("path").alias("sha256"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified_at"),
    )


GONE = ("DELETED", "ABSENT")
"""Outcomes after which a file is no longer there."""


def _plain(uri: str) -> str:
    return "/" + uri.split(":", 1)[-1].lstrip("/") if uri.startswith("file:") or "://" not in uri else uri


def _delete(keys: Iterator[pa.RecordBatch], inside: str) -> Iterator[pa.RecordBatch]:
    """Deletes single files below a folder; a file that is gone already is no failure, so a task may repeat."""
    folder = _plain(inside).rstrip("/") + "/"
    for batch in keys:
        outcomes = []
        for key in batch.column(0).to_pylist():
            path = _plain(key or "")
            if not path.startswith(folder) or ".." in path.split("/"):
                outcomes.append("REFUSED")
                continue
            try:
                files, place = (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)
                kind = files.get_file_info(place).type
                if kind == fs.FileType.File:
                    files.delete_file(place)
                outcomes.append({fs.FileType.File: "DELETED", fs.FileType.NotFound: "ABSENT"}.get(kind, "REFUSED"))
            except FileNotFoundError:
                outcomes.append("ABSENT")
            except (OSError, ValueError) as error:
                outcomes.append(f"FAILED: {error}"[:500])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(outcomes, pa.string())], ["raw_key", "outcome"])


def delete_files(keys: DataFrame, inside: str, tasks: int | None = None) -> DataFrame:
    """(raw_key, outcome) of `keys` (raw_key): each file is deleted in a task, if it lies inside the folder.

    Outcomes: DELETED, ABSENT (it was gone), REFUSED (outside the folder, or no single file), or FAILED with the
    reason. Lazy: write the result, or the files are asked for again with every use.
    """
    dealt = keys.select("raw_key").distinct().repartition(tasks or keys.sparkSession.sparkContext.defaultParallelism)
    return dealt.mapInArrow(lambda batches: _delete(batches, inside), "raw_key string, outcome string")


def raw_key(folder: str, dataset_id: str, sha256: str, file_name: str) -> str:
    return f"{folder.rstrip('/')}/{dataset_id}/sha256={sha256}/{file_name}"


def classify_uploads(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """incoming and stored are (raw_key, size, sha256): UPLOADED, ALREADY_EXISTS, CONFLICT, or STORED_ONLY."""
    a = incoming.select("raw_key", F.col("size").alias("size_in"), F.col("sha256").alias("sha_in"))
    b = stored.select("raw_key", F.col("size").alias("size_at"), F.col("sha256").alias("sha_at"))
    same = (F.col("size_in") == F.col("size_at")) & (F.col("sha_at").isNull() | (F.col("sha_in") == F.col("sha_at")))
    return a.join(b, "raw_key", "full_outer").withColumn(
        "status",
        F.when(F.col("size_in").isNull(), "STORED_ONLY")
        .when(F.col("size_at").isNull(), "UPLOADED")
        .when(same, "ALREADY_EXISTS")
        .otherwise("CONFLICT"),
    )
