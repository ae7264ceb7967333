"""Ledger operators over runs and manifests that Spark derives from the given tables.

Events play manifest rows (one per run and dataset), users play runs.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.operators import ledger as L
from estrato.operators.relational import without
from estrato.session import scratch_folder, shared_folder
from estrato.sources import delimited as D
from estrato.sources import files as FS
from estrato.sources import snapshots as S
from estrato.sources.rowlog import RowLog, newest_rows
from suite.raw_tables import table
from suite.registry import Registry


def runs(s, d):
    return table(s, d, "events").groupBy("user_id").agg(F.max("event_id").alias("m")).select(
        F.col("user_id").cast("string").alias("ingestion_run_id"),
        F.when(F.col("user_id") % 4 == 0, "FAILED").when(F.col("user_id") % 7 == 0, "NO_CHANGE").otherwise("SUCCESS").alias("status"),
        F.lpad(F.col("m").cast("string"), 12, "0").alias("end_time_utc"),
        F.lpad((F.col("m") - 1).cast("string"), 12, "0").alias("start_time_utc"),
    )


def manifest(s, d):
    e = F.col("event_id")
    return table(s, d, "events").select(
        F.col("user_id").cast("string").alias("ingestion_run_id"), F.col("event_type").alias("dataset_id"),
        F.concat(F.lit("ab"), (e % 37).cast("string")).alias("source_sha256"),
        F.lpad(e.cast("string"), 12, "0").alias("ingested_at_utc"),
        F.when(e % 5 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
        F.concat(F.lit("raw/"), "event_type", F.lit("/sha256=ab"), (e % 37).cast("string"), F.lit("/f.zip")).alias("raw_s3_key"),
        F.lit("ACTIVE").alias("retention_status"),
    )


def inventory(s, d):
    return table(s, d, "events").select(
        F.col("event_type").alias("dataset_id"),
        F.concat(F.lit("raw/"), "event_type", F.lit("/sha256=ab"), (F.col("event_id") % 50).cast("string"), F.lit("/f.zip")).alias("raw_key"),
    ).distinct()


RUNS = """SELECT CAST(user_id AS VARCHAR) AS ingestion_run_id, CASE WHEN user_id % 4 = 0 THEN 'FAILED' WHEN user_id % 7 = 0 THEN 'NO_CHANGE' ELSE 'SUCCESS' END AS status,
 lpad(CAST(max(event_id) AS VARCHAR), 12, '0') AS end_time_utc, lpad(CAST(max(event_id) - 1 AS VARCHAR), 12, '0') AS start_time_utc FROM events GROUP BY user_id"""
MANIFEST = """SELECT CAST(user_id AS VARCHAR) AS ingestion_run_id, event_type AS dataset_id, 'ab' || CAST(event_id % 37 AS VARCHAR) AS source_sha256,
 lpad(CAST(event_id AS VARCHAR), 12, '0') AS ingested_at_utc, CASE WHEN event_id % 5 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
 'raw/' || event_type || '/sha256=ab' || CAST(event_id % 37 AS VARCHAR) || '/f.zip' AS raw_s3_key, 'ACTIVE' AS retention_status FROM events"""
GOOD = f"SELECT m.*, r.end_time_utc AS run_end FROM ({MANIFEST}) m JOIN ({RUNS}) r ON m.ingestion_run_id = r.ingestion_run_id WHERE m.status = 'SUCCESS' AND r.status = 'SUCCESS'"
RECENT = f"""SELECT dataset_id, source_sha256, last_used, CAST(row_number() OVER (PARTITION BY dataset_id ORDER BY last_used DESC, source_sha256 DESC) AS INTEGER) AS recency
 FROM (SELECT dataset_id, source_sha256, max(ingested_at_utc) AS last_used FROM ({GOOD}) GROUP BY ALL) QUALIFY recency <= 2"""


def register(reg: Registry) -> None:
    reg.add("ledger_active_snapshots", lambda s, d: L.active_snapshots(runs(s, d), manifest(s, d)),
            f"SELECT * EXCLUDE (run_end) FROM ({GOOD}) QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY run_end DESC, ingested_at_utc DESC) = 1")
    reg.add("ledger_last_successful_run", lambda s, d: L.last_successful_run(runs(s, d)),
            f"SELECT * FROM ({RUNS}) WHERE status = 'SUCCESS' ORDER BY end_time_utc DESC LIMIT 1")
    reg.add("ledger_last_five_runs", lambda s, d: L.last_runs(runs(s, d)), f"SELECT * FROM ({RUNS}) ORDER BY start_time_utc DESC, ingestion_run_id DESC LIMIT 5")
    reg.add("ledger_latest_per_order", lambda s, d: L.latest_per_key(
        table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("string").alias("moment"), F.col("l_extendedprice").cast("string").alias("price")).distinct(),
        ["l_orderkey"], ["moment", "price"]).select("l_orderkey", "moment", "price"),
        """SELECT l_orderkey, moment, price FROM (SELECT l_orderkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS moment, CAST(l_extendedprice AS VARCHAR) AS price FROM lineitem)
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY moment DESC, price DESC) = 1""")
    new = lambda s, d: manifest(s, d).filter("ingested_at_utc LIKE '%7'").withColumn("status", F.lit("REPLACED"))
    reg.add("ledger_upsert", lambda s, d: L.upsert(manifest(s, d), new(s, d), ["ingestion_run_id", "ingested_at_utc"]),
            f"SELECT * REPLACE (CASE WHEN ingested_at_utc LIKE '%7' THEN 'REPLACED' ELSE status END AS status) FROM ({MANIFEST})")
    reg.add("ledger_mark_deleted", lambda s, d: L.update_matching(
        manifest(s, d), inventory(s, d).filter("raw_key LIKE '%ab3%'").select(F.col("raw_key").alias("raw_s3_key")), "raw_s3_key", {"retention_status": F.lit("DELETED")}),
        f"SELECT * REPLACE (CASE WHEN raw_s3_key LIKE '%ab3%' THEN 'DELETED' ELSE retention_status END AS retention_status) FROM ({MANIFEST})")
    reg.add("ledger_recent_hashes", lambda s, d: L.recent_hashes(runs(s, d), manifest(s, d), 2), RECENT)
    reg.add("ledger_retention_plan", lambda s, d: L.retention_plan(runs(s, d), manifest(s, d), inventory(s, d)),
            f"""SELECT i.dataset_id, i.raw_key, CASE WHEN EXISTS (SELECT 1 FROM ({RECENT}) h WHERE h.dataset_id = i.dataset_id AND i.raw_key LIKE '%sha256=' || h.source_sha256 || '/%')
            THEN 'PROTECTED' ELSE 'CANDIDATE' END AS action FROM (SELECT DISTINCT event_type AS dataset_id,
            'raw/' || event_type || '/sha256=ab' || CAST(event_id % 50 AS VARCHAR) || '/f.zip' AS raw_key FROM events) i""")
    reg.add("ledger_publication_gaps", lambda s, d: L.publication_gaps(
        inventory(s, d).select("dataset_id").distinct().unionByName(table(s, d, "region").select(F.col("r_name").alias("dataset_id"))), manifest(s, d), "9"),
            f"SELECT dataset_id FROM (SELECT DISTINCT event_type AS dataset_id FROM events UNION ALL SELECT r_name FROM region) WHERE dataset_id NOT IN (SELECT dataset_id FROM ({MANIFEST}) WHERE ingestion_run_id = '9' AND status = 'SUCCESS')")
    reg.add("ledger_reuse_candidates", lambda s, d: L.reuse_candidates(
        L.active_snapshots(runs(s, d), manifest(s, d)).select("dataset_id", F.when(F.col("dataset_id") < "m", F.col("source_sha256")).otherwise("new").alias("source_sha256")),
        L.active_snapshots(runs(s, d), manifest(s, d)).withColumn("original_run_id", F.lit(None).cast("string")),
        inventory(s, d).select("dataset_id").distinct(), False),
        f"""SELECT dataset_id, CASE WHEN dataset_id < 'm' THEN source_sha256 ELSE 'new' END AS source_sha256, CASE WHEN dataset_id < 'm' THEN 'REUSE' ELSE 'LOAD' END AS action,
        CASE WHEN dataset_id < 'm' THEN 'same hash as run ' || ingestion_run_id END AS reuse_reason, CASE WHEN dataset_id < 'm' THEN ingestion_run_id END AS original_run_id
        FROM (SELECT * FROM ({GOOD}) QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY run_end DESC, ingested_at_utc DESC) = 1)""")
    reg.add("ledger_branch_after_ingest", lambda s, d: L.branch_after_ingest(runs(s, d), "7"), f"""SELECT CASE max(status) WHEN 'NO_CHANGE' THEN 'SKIP' WHEN 'SUCCESS' THEN 'TRANSFORM'
        ELSE 'ERROR_STATUS_' || max(status) END AS branch FROM ({RUNS}) WHERE ingestion_run_id = '7'""")
    reg.add("ledger_known_exceptions_removed", lambda s, d: without(table(s, d, "orders").select(F.nullif(F.col("o_custkey") % 9, F.lit(4)).alias("k")).groupBy("k").agg(F.count("*").alias("n")), "k", [1, 2]),
            "SELECT nullif(o_custkey % 9, 4) AS k, count(*) AS n FROM orders WHERE coalesce(nullif(o_custkey % 9, 4) NOT IN (1, 2), TRUE) GROUP BY ALL")
    reg.add("ledger_change_decisions", change_decisions, CHANGES)
    reg.add("ledger_local_state", local_state, LOCAL_STATE)
    reg.add("ledger_retention_outcomes", retention_outcomes, OUTCOMES)
    reg.add("ledger_newest_rows", newest_with_ties, NEWEST)
    reg.add("ledger_log_after_entries", log_after_entries, LOG)
    reg.add("strict_read_of_orders", strict_read, "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, '  a;\"b\" ' || o_orderstatus AS note, CAST(NULL AS VARCHAR) AS broken FROM orders")
    reg.add("file_contract_findings", file_contract, """SELECT * FROM (VALUES ('b', ': missing [], extra [], other order or number'), ('c', ': missing [o_orderpriority], extra [o_clerk]')) v(folder, finding)
        WHERE (SELECT count(*) FROM orders) > 0""")


def change_decisions(s, d):
    """Every outcome of the decision, on the last successful run of the data."""
    r = runs(s, d).withColumn("source_data_carga_raw_initial", F.concat(F.lit("m"), "ingestion_run_id"))
    r = r.withColumn("source_data_carga_raw_final", F.when(F.col("ingestion_run_id").cast("int") % 3 == 0, F.lit("")))
    last = L.last_successful_run(r)
    types = inventory(s, d).select("dataset_id").distinct()
    intact = types.withColumn("reason", F.lit(None).cast("string"))
    damaged = types.withColumn("reason", F.when(F.col("dataset_id") == "click", "TABLE_EMPTY").when(F.col("dataset_id") < "m", "RAW_FILE_MISSING"))
    same = F.col("__marker")
    cases = {
        "forced": (last, same, damaged, True), "first": (L.last_successful_run(r.filter("status = 'FAILED'")), same, intact, False),
        "changed": (last, F.concat(same, F.lit("x")), intact, False), "damaged": (last, same, damaged, False), "same": (last, same, intact, False),
    }
    parts = [L.change_decision(*args).select(F.lit(name).alias("situation"), "skip", "reason") for name, args in cases.items()]
    return reduce(DataFrame.unionByName, parts)


CHANGES = f"""SELECT situation, reason = 'NO_CHANGE' AS skip, reason FROM (
 SELECT unnest(['forced', 'first', 'changed', 'damaged', 'same']) AS situation,
  unnest(['FORCED', 'NO_PREVIOUS_SUCCESS', 'MARKER_CHANGED', CASE WHEN (SELECT count(*) FROM events WHERE event_type < 'm') > 0 THEN 'LOCAL_STATE_INCOMPLETE' ELSE 'NO_CHANGE' END, 'NO_CHANGE']) AS reason)
 WHERE (SELECT count(*) FROM ({RUNS}) WHERE status = 'SUCCESS') > 0"""


def local_state(s, d):
    """Datasets whose table is absent or empty, that have no active snapshot, or whose raw file is gone."""
    registry = inventory(s, d).select("dataset_id", F.concat(F.lit("t_"), "dataset_id").alias("table_name")).distinct().unionByName(
        table(s, d, "region").select(F.col("r_name").alias("dataset_id"), F.concat(F.lit("t_"), "r_name").alias("table_name")))
    sizes = table(s, d, "events").groupBy(F.concat(F.lit("t_"), "event_type").alias("table_name")).agg(F.count("*").alias("n_rows")).unionByName(
        table(s, d, "region").filter("r_regionkey < 4").select(F.concat(F.lit("t_"), "r_name").alias("table_name"), F.when(F.col("r_regionkey") > 1, F.lit(5)).otherwise(F.lit(0)).cast("bigint").alias("n_rows")))
    active = L.active_snapshots(runs(s, d), manifest(s, d))
    return L.local_state(registry, sizes, active, inventory(s, d).filter("dataset_id > 'd'"))


LOCAL_STATE = f"""WITH active AS (SELECT * FROM ({GOOD}) QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY run_end DESC, ingested_at_utc DESC) = 1),
 stored AS (SELECT DISTINCT 'raw/' || event_type || '/sha256=ab' || CAST(event_id % 50 AS VARCHAR) || '/f.zip' AS k FROM events WHERE event_type > 'd')
 SELECT dataset_id, CASE WHEN raw_s3_key NOT IN (SELECT k FROM stored) THEN 'RAW_FILE_MISSING' END AS reason FROM active
 UNION ALL SELECT DISTINCT event_type, 'NO_ACTIVE_SNAPSHOT' FROM events WHERE event_type NOT IN (SELECT dataset_id FROM active)
 UNION ALL SELECT r_name, CASE WHEN r_regionkey >= 4 THEN 'TABLE_MISSING' WHEN r_regionkey > 1 THEN 'NO_ACTIVE_SNAPSHOT' ELSE 'TABLE_EMPTY' END FROM region"""


def retention_outcomes(s, d):
    """Raw files written from the given table, the plan's candidates deleted in tasks, and what became of them.

    Of every dataset's candidates the files with an odd number were gone before, and one key lies outside the folder.
    """
    plan = S.materialize(s, L.retention_plan(runs(s, d), manifest(s, d), inventory(s, d)), f"{scratch_folder(s)}/plan-{uuid.uuid4().hex}")
    folder = f"{shared_folder(s)}/raw-{uuid.uuid4().hex}"
    here = F.concat(F.lit(f"{folder}/"), F.regexp_replace("raw_key", "[^A-Za-z0-9]", "_"))
    number = F.regexp_extract("raw_key", "sha256=ab([0-9]+)/", 1).cast("int")
    placed = plan.select("dataset_id", "action", here.alias("raw_key"), number.alias("number"))
    _touch(placed.filter("action = 'PROTECTED' OR number % 2 = 0").select("raw_key"))
    wanted = placed.filter("action = 'CANDIDATE'")
    outside = s.createDataFrame([(f"{folder}-other/f",)], "raw_key string")
    outcomes = S.materialize(s, FS.delete_files(wanted.select("raw_key").union(outside), folder), f"{scratch_folder(s)}/outcomes-{uuid.uuid4().hex}")
    counted = outcomes.join(wanted, "raw_key", "left").groupBy("dataset_id").agg(
        F.count("*").alias("candidates"), *[F.count_if(F.col("outcome") == o).alias(o.lower()) for o in ("DELETED", "ABSENT", "REFUSED")])
    again = FS.delete_files(wanted.select("raw_key"), folder).join(wanted, "raw_key").groupBy("dataset_id").agg(F.count_if(F.col("outcome") == "ABSENT").alias("absent_when_repeated"))
    return counted.join(again, "dataset_id", "left").select("*", F.when(F.col("refused") > 0, "PARTIAL_FAILURE").otherwise("EXECUTED").alias("status"))


def _touch(keys):
    """Writes a small file of each name, in tasks."""
    def write(batches):
        for batch in batches:
            for key in batch.column(0).to_pylist():
                files, path = fs.FileSystem.from_uri(key if "://" in key else "file://" + key.removeprefix("file:"))
                files.create_dir(path.rpartition("/")[0], recursive=True)
                with files.open_output_stream(path) as out:
                    out.write(b"raw")
            yield batch

    keys.repartition(8).mapInArrow(write, "raw_key string").count()


OUTCOMES = f"""WITH plan AS (SELECT i.dataset_id, i.number, EXISTS (SELECT 1 FROM ({RECENT}) h WHERE h.dataset_id = i.dataset_id AND i.raw_key LIKE '%sha256=' || h.source_sha256 || '/%') AS kept
 FROM (SELECT DISTINCT event_type AS dataset_id, event_id % 50 AS number, 'raw/' || event_type || '/sha256=ab' || CAST(event_id % 50 AS VARCHAR) || '/f.zip' AS raw_key FROM events) i)
 SELECT dataset_id, count(*) AS candidates, count(*) FILTER (WHERE number % 2 = 0) AS deleted, count(*) FILTER (WHERE number % 2 = 1) AS absent, CAST(0 AS BIGINT) AS refused,
 count(*) AS absent_when_repeated, 'EXECUTED' AS status FROM plan WHERE NOT kept GROUP BY dataset_id
 UNION ALL SELECT NULL, 1, 0, 0, 1, NULL, 'PARTIAL_FAILURE' FROM (SELECT count(*) AS n FROM events) WHERE n > 0"""


def newest_with_ties(s, d):
    """Entries per user and event type, read by their newest: many share a moment, some a writer too."""
    e = F.col("event_id")
    log = table(s, d, "events").select("user_id", "event_type", "event_id", (e % 10).alias("__moment"), (e % 3).cast("string").alias("__writer"))
    return newest_rows(log, ["user_id", "event_type"])


NEWEST = """SELECT user_id, event_type, event_id FROM events
 QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 10 DESC, event_id % 3 DESC, event_id DESC) = 1"""


def log_after_entries(s, d):
    """A log after entries made from the given table, before and after compaction: what is read and how many files hold it."""
    place = f"{scratch_folder(s)}/log-{uuid.uuid4().hex}"
    rows = runs(s, d)
    log = RowLog(s, place, rows.schema, ["ingestion_run_id"])
    log.append(rows)
    log.append(rows.filter("status = 'FAILED'").withColumn("status", F.lit("SUCCESS")))
    log.append(rows.filter("ingestion_run_id % 8 = 0").withColumn("status", F.lit("AGAIN")))
    before, files = S.materialize(s, log.read(), f"{place}-before"), len(log._files())
    log.compact()
    both = log.read().join(before.withColumnRenamed("status", "status_before"), ["ingestion_run_id", "end_time_utc", "start_time_utc"], "full_outer")
    return both.groupBy("status", "status_before").agg(F.count("*").alias("n")).withColumn("entries", F.lit(files)).withColumn("entries_left", F.lit(len(log._files())))


LOG = f"""SELECT status, status AS status_before, count(*) AS n, CAST(3 AS INTEGER) AS entries, CAST(0 AS INTEGER) AS entries_left FROM (
 SELECT CASE WHEN CAST(ingestion_run_id AS BIGINT) % 8 = 0 THEN 'AGAIN' WHEN status = 'FAILED' THEN 'SUCCESS' ELSE status END AS status FROM ({RUNS})) GROUP BY status"""


def _text_files(df, folder, name):
    """Semicolon text with a header in every file, below the folder that all executors share."""
    df.write.csv(f"{folder}/{name}", sep=";", header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def strict_read(s, d):
    folder = f"{shared_folder(s)}/strict-{uuid.uuid4().hex}"
    orders = table(s, d, "orders").select("o_orderkey", "o_orderpriority", F.concat(F.lit('  a;"b" '), "o_orderstatus").alias("note"))
    _text_files(orders.repartition(3), folder, "orders")
    names = D.checked_header(s, f"{folder}/orders")
    return D.read_checked(s, f"{folder}/orders", names).select(*names, F.col(D.BROKEN).alias("broken"))


def file_contract(s, d):
    """Three sets of files in one input: the first as wanted, the second with columns changed round, the third with another one."""
    folder = f"{shared_folder(s)}/mixed-{uuid.uuid4().hex}"
    orders = table(s, d, "orders").select("o_orderkey", "o_orderpriority")
    for name, columns in (("a", ["o_orderkey", "o_orderpriority"]), ("b", ["o_orderpriority", "o_orderkey"]), ("c", ["o_orderkey", F.col("o_orderpriority").alias("o_clerk")])):
        _text_files(orders.select(*columns), folder, name)
    found = D.file_findings(D.line_report(s, f"{folder}/*"))
    return found.select(F.regexp_extract("file", "/([abc])/[^/]*$", 1).alias("folder"), F.regexp_extract("finding", ": missing.*$", 0).alias("finding")).distinct()
