"""Ingest run: control marker, datasets, publication gates, ledger, retention."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.operators import ledger as L
from estrato.sources import delimited as D
from estrato.sources import files as FS
from estrato.sources import snapshots as S
from estrato.sources.rowlog import RowLog


@dataclass(frozen=True)
class Dataset:
    """One source: the file (or files) to read and the table it becomes."""

    dataset_id: str
    path: str
    source_file: str
    table: str
    raw_key: str | None = None
    multiline: bool = True  # False: no field holds a line end, so that files are split



class Ledger:
    """The two ledger tables: one row per run and per (run, dataset), appended to and read by their newest rows."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.runs_path = f"{folder}/ingestion_runs"
        self.manifest_path = f"{folder}/ingestion_manifest"
        self._runs = RowLog(spark, self.runs_path, L.RUNS_SCHEMA, ["ingestion_run_id"])
        self._manifest = RowLog(spark, self.manifest_path, L.MANIFEST_SCHEMA, ["ingestion_run_id", "dataset_id"])

    def runs(self) -> DataFrame:
        return self._runs.read()

    def manifest(self) -> DataFrame:
        return self._manifest.read()

    def active(self) -> DataFrame:
        return L.active_snapshots(self.runs(), self.manifest())

    def compact(self) -> None:
        self._runs.compact()
        self._manifest.compact()

    def _put_run(self, row: Mapping) -> None:
        new = self.spark.createDataFrame([tuple(row.get(n) for n in L.RUNS_SCHEMA.names)], L.RUNS_SCHEMA)
        self._runs.append(new)

    def start_run(self, run_id: str, at: str, force: bool, control: Mapping | None, total: int) -> None:
        control = control or {}
        self._put_run({
            "ingestion_run_id": run_id, "start_time_utc": at, "status": "RUNNING", "force": force,
            "source_data_carga_raw_initial": control.get("marker"), "source_data_carga_initial": control.get("marker_at"),
            "control_zip_sha256": control.get("sha256"), "total_datasets": total, "successful_datasets": 0,
            "retention_status": "PENDING",
        })

    def finish_run(self, run_id: str, at: str, status: str, control: Mapping | None = None, successful: int = 0,
                   error: str | None = None, retention: str = "SKIPPED") -> None:
        """Closes a run; what was known at its start is kept."""
        found = self.runs().filter(F.col("ingestion_run_id") == run_id).limit(1).collect()
        control = control or {}
        row = found[0].asDict() if found else {
            "ingestion_run_id": run_id, "start_time_utc": at, "force": False,
            "source_data_carga_raw_initial": control.get("marker"), "source_data_carga_initial": control.get("marker_at"),
            "control_zip_sha256": control.get("sha256"),
        }
        row.update({
            "end_time_utc": at, "status": status, "successful_datasets": successful, "error_message": error,
            "source_data_carga_raw_final": control.get("marker") or row.get("source_data_carga_raw_initial"),
            "source_data_carga_final": control.get("marker_at") or row.get("source_data_carga_initial"),
            "retention_status": retention,
        })
        self._put_run(row)

    def record(self, *entries: Mapping) -> None:
        """Writes manifest rows, replacing earlier ones of the same run and dataset."""
        rows = []
        for entry in entries:
            full = {"status": L.SUCCESS, "retention_status": "ACTIVE", **entry}
            if isinstance(full.get("columns"), (list, tuple)):
                full["columns_json"] = json.dumps(list(full["columns"]))
            rows.append(tuple(full.get(n) for n in L.MANIFEST_SCHEMA.names))
        new = self.spark.createDataFrame(rows, L.MANIFEST_SCHEMA)
        self._manifest.append(new)

    def set_retention_status(self, run_id: str, status: str) -> None:
        self._runs.append(self.runs().filter(F.col("ingestion_run_id") == run_id).withColumn("retention_status", F.lit(status)))

    def mark_deleted(self, keys: DataFrame, at: str) -> None:
        """Appends the manifest rows of the given raw_s3_key values as deleted; the keys are joined, never gathered."""
        rows = self.manifest().join(keys.select("raw_s3_key").distinct(), "raw_s3_key", "left_semi")
        self._manifest.append(rows.withColumns({"retention_status": F.lit("DELETED"), "retention_deleted_at_utc": F.lit(at)}))


def ingest_dataset(spark: SparkSession, dataset: Dataset, run_id: str, at: str, sha256: str, report: DataFrame | None = None) -> dict:
    """Checks the file, writes it as a new version with lineage, and returns its manifest entry.

    ``report`` is what delimited.line_report found, where the caller has it already.

    Header and encoding are checked first. Record widths are checked on the rows as they are
    written: the write observes broken records and the version is only published without any.
    """
    started = time.time()
    names = D.checked_header(spark, dataset.path, multiline=dataset.multiline, report=report)
    read = D.read_checked(spark, dataset.path, names, multiline=dataset.multiline)
    rows = D.add_lineage(read, at, run_id, dataset.source_file, sha256)

    def check(observed: dict) -> None:
        if observed["broken"]:
            raise D.ContractError(
                f"{dataset.path}: {observed['broken']} records without {len(names)} fields, first in "
                f"{D.first_broken(spark, dataset.path, names)}")

    seen: dict = {}
    version = S.overwrite_snapshot(
        spark, rows, dataset.table, check=lambda o: (seen.update(o), check(o))[1],
        metrics={"broken": F.count(D.BROKEN)}, drop=[D.BROKEN], rebalance=True,
    )
    return {
        "ingestion_run_id": run_id, "dataset_id": dataset.dataset_id, "source_member_file": dataset.source_file,
        "source_sha256": sha256, "ingested_at_utc": at, "retrieved_at_utc": at, "encoding": "utf-8-sig",
        "delimiter": D.DELIMITER, "columns": names, "logical_input_rows": seen["rows"], "delta_output_rows": seen["rows"],
        "raw_s3_key": dataset.raw_key, "delta_table_path": dataset.table, "delta_version": version,
        "duration_seconds": time.time() - started, "status": L.SUCCESS, "original_run_id": run_id,
    }


def _registry(spark: SparkSession, datasets: Sequence[Dataset]) -> DataFrame:
    return spark.createDataFrame([(d.dataset_id, d.table) for d in datasets], "dataset_id string, table_name string")


def active_version(spark: SparkSession, ledger: Ledger, dataset: Dataset) -> int | None:
    """Version that the latest successful run published; a later run that failed does not count."""
    row = ledger.active().filter(F.col("dataset_id") == dataset.dataset_id).select("delta_version").first()
    return None if row is None else row["delta_version"]


def active_table(spark: SparkSession, ledger: Ledger, dataset: Dataset) -> DataFrame:
    version = active_version(spark, ledger, dataset)
    if version is None:
        raise S.SnapshotError(f"{dataset.dataset_id} has no active version")
    return S.read_snapshot(spark, dataset.table, version)


def _table_sizes(spark: SparkSession, ledger: Ledger, datasets: Sequence[Dataset]) -> DataFrame:
    """Rows of each dataset's active version; datasets without one are left out."""
    versions = {r["dataset_id"]: r["delta_version"] for r in ledger.active().select("dataset_id", "delta_version").collect()}
    sizes = [
        (d.dataset_id, d.table, S.read_snapshot(spark, d.table, versions[d.dataset_id]).count())
        for d in datasets if versions.get(d.dataset_id) in S.published_versions(spark, d.table)
    ]
    return spark.createDataFrame(sizes, "dataset_id string, table_name string, n_rows bigint")


def _marker(spark: SparkSession, path: str) -> dict:
    marker, moment = D.read_control(spark, path)
    return {"marker": marker, "marker_at": moment.strftime("%Y-%m-%d %H:%M:%S")}


def run(spark: SparkSession, ledger: Ledger, datasets: Sequence[Dataset], control_path: str, run_id: str, at: str,
        raw_folder: str | None = None, force: bool = False, control_after: str | None = None) -> str:
    """One ingest run; returns its final status (SUCCESS or NO_CHANGE) and raises after recording a failure."""
    control = _marker(spark, control_path)
    registry = _registry(spark, datasets)
    last = L.last_successful_run(ledger.runs())
    sizes = _table_sizes(spark, ledger, datasets)
    active = ledger.active()
    inventory = FS.raw_inventory(spark, raw_folder) if raw_folder else active.select(F.col("raw_s3_key").alias("raw_key"))
    broken = L.local_state(registry, sizes.drop("dataset_id"), active, inventory)
    decision = L.change_decision(last, control["marker"], broken, force).first()
    ledger.start_run(run_id, at, force, control, len(datasets))
    if decision["skip"]:
        ledger.finish_run(run_id, at, "NO_CHANGE", control, len(datasets))
        return "NO_CHANGE"

    reports = {d.dataset_id: D.line_report(spark, d.path) for d in datasets}  # one pass for fingerprint, header and text checks
    hashes = {name: FS.combined_fingerprint(report).first()[0] for name, report in reports.items()}
    incoming = spark.createDataFrame(list(hashes.items()), "dataset_id string, source_sha256 string")
    plan = {r["dataset_id"]: r for r in L.reuse_candidates(incoming, active, sizes.filter("n_rows > 0"), force).collect()}
    known = {r["dataset_id"]: r.asDict() for r in active.collect()}  # one row per registered dataset
    for dataset in datasets:
        choice = plan[dataset.dataset_id]
        if choice["action"] == "REUSE":
            ledger.record({**known[dataset.dataset_id], "ingestion_run_id": run_id, "reuse_reason": choice["reuse_reason"],
                           "original_run_id": choice["original_run_id"], "retrieved_at_utc": at, "duration_seconds": 0.0,
                           "retention_status": "ACTIVE", "retention_deleted_at_utc": None, "error_message": None})
            continue
        try:
            ledger.record(ingest_dataset(spark, dataset, run_id, at, hashes[dataset.dataset_id], reports[dataset.dataset_id]))
        except Exception as error:
            ledger.record({"ingestion_run_id": run_id, "dataset_id": dataset.dataset_id, "status": "FAILED",
                           "error_message": str(error)})
            ledger.finish_run(run_id, at, "FAILED", control, error=str(error))
            raise

    after = _marker(spark, control_after or control_path)
    done = ledger.manifest().filter((F.col("ingestion_run_id") == run_id) & (F.col("status") == L.SUCCESS)).count()
    problem = None
    if after["marker"] != control["marker"]:
        problem = f"control marker changed during the run from {control['marker']} to {after['marker']}"
    elif not L.publication_gaps(registry, ledger.manifest(), run_id).isEmpty():
        problem = f"partial publication: {done} of {len(datasets)} datasets"
    if problem:
        ledger.finish_run(run_id, at, "FAILED", after, done, problem)
        raise RuntimeError(problem)
    ledger.record({"ingestion_run_id": run_id, "dataset_id": "control", "ingested_at_utc": at, "columns": [D.CONTROL_COLUMN],
                   "logical_input_rows": 1, "delta_output_rows": 0, "original_run_id": run_id})
    ledger.finish_run(run_id, at, L.SUCCESS, after, done, retention="PENDING")
    return L.SUCCESS


def apply_retention(spark: SparkSession, ledger: Ledger, raw_folder: str, run_id: str, at: str, keep: int = 2,
                    dry_run: bool = False) -> str:
    """Deletes raw files outside the newest ``keep`` distinct hashes; skipped unless the run succeeded."""
    good = ledger.runs().filter((F.col("ingestion_run_id") == run_id) & (F.col("status") == L.SUCCESS))
    if good.isEmpty():
        return "SKIPPED"
    plan = L.retention_plan(ledger.runs(), ledger.manifest(), FS.raw_inventory(spark, raw_folder), keep)
    candidates = plan.filter(F.col("action") == "CANDIDATE").select("raw_key").distinct()
    if dry_run:
        status = L.retention_status(candidates.count(), 0, True)
    else:
        outcomes = S.materialize(spark, FS.delete_files(candidates, raw_folder), f"{ledger.runs_path}_retention_{run_id}")
        gone = F.col("outcome").isin(*FS.GONE)
        ledger.mark_deleted(outcomes.filter(gone).select(F.col("raw_key").alias("raw_s3_key")), at)
        n = outcomes.agg(F.count("*"), F.count_if(~gone)).first()
        status = L.retention_status(n[0], n[1], False)
    ledger.set_retention_status(run_id, status)
    return status
