"""Run and manifest ledger: schemas, keyed upserts, and the decisions taken from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.functions import sha256_in_path
from estrato.operators.skew import null_safe_match

SUCCESS = "SUCCESS"


STRING, BOOLEAN, INT, LONG, DOUBLE = T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.DoubleType()

# Columns of the two ledger tables.
RUNS_SCHEMA = T.StructType([
    T.StructField("ingestion_run_id", STRING, False),
    T.StructField("start_time_utc", STRING, False),
    T.StructField("end_time_utc", STRING, True),
    T.StructField("status", STRING, False),
    T.StructField("force", BOOLEAN, False),
    T.StructField("source_data_carga_raw_initial", STRING, True),
    T.StructField("source_data_carga_raw_final", STRING, True),
    T.StructField("source_data_carga_initial", STRING, True),
    T.StructField("source_data_carga_final", STRING, True),
    T.StructField("control_zip_sha256", STRING, True),
    T.StructField("total_datasets", INT, True),
    T.StructField("successful_datasets", INT, True),
    T.StructField("error_message", STRING, True),
    T.StructField("retention_status", STRING, True),
])
MANIFEST_SCHEMA = T.StructType([
    T.StructField("ingestion_run_id", STRING, False),
    T.StructField("dataset_id", STRING, False),
    T.StructField("source_url", STRING, True),
    T.StructField("source_zip_file", STRING, True),
    T.StructField("source_member_file", STRING, True),
    T.StructField("source_sha256", STRING, True),
    T.StructField("file_size_bytes", LONG, True),
    T.StructField("retrieved_at_utc", STRING, True),
    T.StructField("ingested_at_utc", STRING, True),
    T.StructField("encoding", STRING, True),
    T.StructField("delimiter", STRING, True),
    T.StructField("columns_json", STRING, True),
    T.StructField("logical_input_rows", LONG, True),
    T.StructField("delta_output_rows", LONG, True),
    T.StructField("raw_s3_key", STRING, True),
    T.StructField("delta_table_path", STRING, True),
    T.StructField("delta_version", LONG, True),
    T.StructField("duration_seconds", DOUBLE, True),
    T.StructField("status", STRING, False),
    T.StructField("reuse_reason", STRING, True),
    T.StructField("original_run_id", STRING, True),
    T.StructField("retention_status", STRING, True),
    T.StructField("retention_deleted_at_utc", STRING, True),
    T.StructField("error_message", STRING, True),
])


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace rows with the same key; the rest stays."""
    kept = existing.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new)


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    return df.withColumns({n: F.when(condition, v).otherwise(F.col(n)) for n, v in values.items()})


def update_matching(df: DataFrame, keys: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """Sets columns on rows whose key is in ``keys``; the key list is joined, never collected."""
    marked = keys.select(F.col(key).alias("__key")).distinct().withColumn("__hit", F.lit(True))
    joined = df.join(marked, df[key] == marked["__key"], "left")
    return update_where(joined, F.col("__hit").isNotNull(), values).drop("__key", "__hit")


def of_successful_runs(runs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Successful manifest rows of successful runs, with the end time of their run."""
    done = runs.filter(F.col("status") == SUCCESS).select(
        "ingestion_run_id", F.col("end_time_utc").alias("run_end_time_utc")
    )
    return manifest.filter(F.col("status") == SUCCESS).join(done, "ingestion_run_id")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """The newest row per key. Aggregates before the shuffle, so a key with many rows is no hot spot.

    Rows that tie on the ordering columns are told apart by their other columns, so the answer does
    not depend on how the rows are spread over tasks.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    order = F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(f"o{i}") for i, c in enumerate(newest_first)], row.alias("tie"))
    return df.groupBy(*keys).agg(F.max_by(row, order).alias("__row")).select("__row.*")


def active_snapshots(runs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Per dataset the manifest row of the latest successful run. Failed or running runs never count."""
    rows = of_successful_runs(runs, manifest)
    return latest_per_key(rows, ["dataset_id"], ["run_end_time_utc", "ingested_at_utc"]).drop("run_end_time_utc")


def last_successful_run(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status") == SUCCESS).orderBy(F.desc_nulls_last("end_time_utc"), F.desc("ingestion_run_id")).limit(1)


def last_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    return runs.orderBy(F.desc("start_time_utc"), F.desc("ingestion_run_id")).limit(n)


def local_state(registry: DataFrame, tables: DataFrame, active: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per dataset: (dataset_id, reason), reason NULL when intact.

    registry (dataset_id, table_name), tables (table_name, n_rows), inventory (raw_key).
    """
    rows = (
        registry.join(tables, "table_name", "left")
        .join(active.select("dataset_id", "raw_s3_key"), "dataset_id", "left")
        .join(inventory.select(F.col("raw_key").alias("raw_s3_key"), F.lit(True).alias("__stored")).distinct(), "raw_s3_key", "left")
        .join(active.select("dataset_id", F.lit(True).alias("__active")), "dataset_id", "left")
    )
    return rows.select(
        "dataset_id",
        F.when(F.col("n_rows").isNull(), "TABLE_MISSING").when(F.col("n_rows") == 0, "TABLE_EMPTY")
        .when(F.col("__active").isNull(), "NO_ACTIVE_SNAPSHOT").when(F.col("__stored").isNull(), "RAW_FILE_MISSING").alias("reason"),
    )


def change_decision(last_run: DataFrame, current_marker: str, broken: DataFrame, force: bool) -> DataFrame:
    """One row (skip, reason). ``last_run`` has at most one row, ``broken`` lists damaged datasets."""
    one = last_run.sparkSession.range(1).select(F.lit(1).alias("__one"))
    last = last_run.select(
        F.lit(1).alias("__one"), F.lit(True).alias("__has"),
        F.coalesce(F.nullif("source_data_carga_raw_final", F.lit("")), "source_data_carga_raw_initial").alias("__marker"),
    )
    damage = broken.filter(F.col("reason").isNotNull()).agg(F.count("*").alias("__damage")).withColumn("__one", F.lit(1))
    reason = (
        F.when(F.lit(force), "FORCED").when(F.col("__has").isNull(), "NO_PREVIOUS_SUCCESS")
        .when(~F.col("__marker").eqNullSafe(F.lit(current_marker)), "MARKER_CHANGED")
        .when(F.col("__damage") > 0, "LOCAL_STATE_INCOMPLETE").otherwise("NO_CHANGE")
    )
    joined = one.join(last, "__one", "left").join(damage, "__one", "left")
    return joined.select(reason.alias("reason")).select((F.col("reason") == "NO_CHANGE").alias("skip"), "reason")


def reuse_candidates(incoming: DataFrame, active: DataFrame, valid_tables: DataFrame, force: bool) -> DataFrame:
    """incoming (dataset_id, source_sha256): REUSE with the first run that loaded the hash, or LOAD."""
    current = active.select(
        "dataset_id", F.col("source_sha256").alias("__sha"), F.col("ingestion_run_id").alias("__run"),
        F.coalesce("original_run_id", "ingestion_run_id").alias("__first"),
    )
    rows = incoming.join(current, "dataset_id", "left").join(
        valid_tables.select("dataset_id", F.lit(True).alias("__valid")), "dataset_id", "left")
    same = (F.col("__sha") == F.col("source_sha256")) & F.col("__valid").isNotNull() & ~F.lit(force)
    reuse = F.coalesce(same, F.lit(False))
    return rows.select(
        "dataset_id", "source_sha256", F.when(reuse, "REUSE").otherwise("LOAD").alias("action"),
        F.when(reuse, F.concat(F.lit("same hash as run "), "__run")).alias("reuse_reason"),
        F.when(reuse, F.col("__first")).alias("original_run_id"),
    )


def publication_gaps(registry: DataFrame, manifest: DataFrame, run_id: str) -> DataFrame:
    """Registered datasets without a successful manifest row in the run; empty means complete."""
    done = manifest.filter((F.col("ingestion_run_id") == run_id) & (F.col("status") == SUCCESS)).select("dataset_id").distinct()
    return registry.select("dataset_id").join(done, "dataset_id", "left_anti")


def branch_after_ingest(runs: DataFrame, run_id: str) -> DataFrame:
    """One row (branch): SKIP, TRANSFORM, or an error when the run is absent, doubled or unsuccessful."""
    found = runs.filter(F.col("ingestion_run_id") == run_id).agg(F.count("*").alias("n"), F.max("status").alias("status"))
    return found.select(
        F.when(F.col("n") == 0, "ERROR_RUN_NOT_FOUND").when(F.col("n") > 1, "ERROR_RUN_REPEATED")
        .when(F.col("status") == "NO_CHANGE", "SKIP").when(F.col("status") == SUCCESS, "TRANSFORM")
        .otherwise(F.concat(F.lit("ERROR_STATUS_"), "status")).alias("branch")
    )


# ---- retention -------------------------------------------------------------------------------------

def recent_hashes(runs: DataFrame, manifest: DataFrame, keep: int) -> DataFrame:
    """The newest ``keep`` distinct hashes per dataset, by the last time each was loaded with success."""
    last_use = of_successful_runs(runs, manifest).filter(F.nullif("source_sha256", F.lit("")).isNotNull()).groupBy(
        "dataset_id", "source_sha256").agg(F.max("ingested_at_utc").alias("last_used"))
    rank = F.row_number().over(W.partitionBy("dataset_id").orderBy(F.desc_nulls_last("last_used"), F.desc("source_sha256")))
    return last_use.withColumn("recency", rank).filter(F.col("recency") <= keep)


def retention_plan(runs: DataFrame, manifest: DataFrame, inventory: DataFrame, keep: int = 2) -> DataFrame:
    """(dataset_id, raw_key, action): PROTECTED by hash or by manifest key, everything else CANDIDATE."""
    hashes = recent_hashes(runs, manifest, keep).select("dataset_id", F.col("source_sha256").alias("sha256"))
    keys = of_successful_runs(runs, manifest).select("dataset_id", F.col("source_sha256").alias("sha256"), "raw_s3_key")
    keys = keys.join(hashes, ["dataset_id", "sha256"], "left_semi").select(F.col("raw_s3_key").alias("raw_key")).distinct()
    listed = inventory.select("dataset_id", "raw_key", sha256_in_path("raw_key").alias("sha256"))
    by_hash = hashes.select(F.col("dataset_id").alias("__d"), F.col("sha256").alias("__s"), F.lit(True).alias("__hash"))
    rows = listed.join(by_hash, null_safe_match(listed, by_hash, [("dataset_id", "__d"), ("sha256", "__s")]), "left").join(
        keys.withColumn("__named", F.lit(True)), "raw_key", "left")
    protected = F.col("__hash").isNotNull() | F.col("__named").isNotNull()
    return rows.select("dataset_id", "raw_key", F.when(protected, "PROTECTED").otherwise("CANDIDATE").alias("action"))


def retention_status(candidates: int, failed: int, dry_run: bool) -> str:
    if dry_run:
        return "DRY_RUN"
    if candidates == 0:
        return "NOOP"
    return "PARTIAL_FAILURE" if failed else "EXECUTED"
