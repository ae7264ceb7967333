import hashlib

import pytest

from estrato.operators import ledger as L
from estrato.plans import ingest as I
from estrato.sources import catalog as CAT
from estrato.sources import delimited as D
from estrato.sources import files as FS
from estrato.sources import snapshots as S


def put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode("utf-8"))
    return str(path)


def test_valid_file(spark, tmp_path):
    path = put(tmp_path, "ok.csv", '﻿ID_PROPOSTA;CODIGO_PROGRAMA;DESCRICAO;VALOR_GLOBAL\r\n000123;0045;"two\r\nlines; ""q""";1,00\r\n000124;0046;plain;\r\n')
    found = D.check_file(spark, path)
    assert found == {"columns": ["ID_PROPOSTA", "CODIGO_PROGRAMA", "DESCRICAO", "VALOR_GLOBAL"], "logical_rows": 2}
    rows = D.read_delimited_strict(spark, path, found["columns"]).orderBy("ID_PROPOSTA").collect()
    assert [r["ID_PROPOSTA"] for r in rows] == ["000123", "000124"]
    assert rows[0]["DESCRICAO"].replace("\r\n", "\n") == 'two\nlines; "q"'


@pytest.mark.parametrize("content, message", [
    (b"COL1;COL2\r\n\x80\x81;VALOR\r\n", "UTF-8"),
    (b"COL1;;COL3\r\na;b;c\r\n", "without a name"),
    (b"ID_ITEM;NOME;ID_ITEM\r\n1;T;1\r\n", "repeated"),
    (b"ID;NOME;__source_sha256\r\n1;T;x\r\n", "reserved"),
    (b"COL1;COL2\r\na;b\r\na;b;c\r\n", "expected 2 fields"),
    (b"COL1;COL2\r\na\r\n", "expected 2 fields"),
    (b"", "empty"),
])
def test_broken_files(spark, tmp_path, content, message):
    with pytest.raises(D.ContractError, match=message):
        D.check_file(spark, put(tmp_path, "bad.csv", content))


@pytest.mark.parametrize("content, status", [
    ("data_carga\n16/09/2026 06:32:11\n", "OK"),
    ("﻿data_carga\r\n16/09/2026 06:32:11\r\n", "OK"),
    ("data_carga;x\n16/09/2026 06:32:11;1\n", "EXTRA_COLUMN"),
    ("data_carga;data_carga\na;b\n", "DUPLICATE_COLUMN"),
    ("other\n16/09/2026 06:32:11\n", "MISSING_COLUMN"),
    ("data_carga\n", "NO_ROWS"),
    ("", "EMPTY_FILE"),
    ("data_carga\n16/09/2026 06:32:11\n17/09/2026 06:32:11\n", "EXTRA_ROWS"),
    ("data_carga\n16/09/2026 06:32:11;x\n", "WIDE_ROW"),
    ("data_carga\n31/02/2026 10:00:00\n", "INVALID_MARKER"),
    ("data_carga\n2026-09-16T06:32:11\n", "INVALID_MARKER"),
    ("data_carga\n   \n", "BLANK_MARKER"),
    (b"data_carga\n\x80\n", "INVALID_TEXT"),
])
def test_control_file(spark, tmp_path, content, status):
    row = D.control_report(spark, put(tmp_path, "control.csv", content)).first()
    assert ("EMPTY_FILE" if row is None else row["status"]) == status


def test_digests(spark, tmp_path):
    for name, body in (("a.zip", b"x"), ("b.zip", b"z"), ("c.zip", b"y"), ("d.zip", b"not a zip"), ("empty.bin", b"")):
        put(tmp_path, name, body)
    digests = FS.file_digests(spark, f"{tmp_path}/*")
    paths = {r["path"].rsplit("/", 1)[1]: r["path"] for r in digests.collect()}
    wanted = [(paths["d.zip"], hashlib.sha256(b"not a zip").hexdigest()), (paths["a.zip"], "00"), (paths["b.zip"], None),
              (f"file:{tmp_path}/empty.bin", None)]
    expected = spark.createDataFrame(wanted, "path string, expected_sha256 string")
    found = {r["path"].rsplit("/", 1)[1]: r["status"] for r in FS.digest_findings(digests, expected).collect()}
    assert found == {"a.zip": "MISMATCH", "b.zip": "OK", "c.zip": "UNEXPECTED", "d.zip": "OK", "empty.bin": "EMPTY"}


def test_classify_uploads(spark):
    schema = "raw_key string, size bigint, sha256 string"
    incoming = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("c", 2, "x"), ("e", 1, "x")], schema)
    stored = spark.createDataFrame([("a", 1, "x"), ("b", 1, None), ("c", 1, "x"), ("d", 1, "x"), ("e", 1, "y")], schema)
    got = {r["raw_key"]: r["status"] for r in FS.classify_uploads(incoming, stored).collect()}
    assert got == {"a": "ALREADY_EXISTS", "b": "ALREADY_EXISTS", "c": "CONFLICT", "d": "STORED_ONLY", "e": "CONFLICT"}


def test_snapshots(spark, tmp_path):
    table = f"{tmp_path}/t"
    assert S.overwrite_snapshot(spark, spark.range(5), table) == 0
    # a new version may read the current one
    assert S.overwrite_snapshot(spark, S.read_snapshot(spark, table).filter("id > 1"), table) == 1
    assert S.read_snapshot(spark, table).count() == 3 and S.read_snapshot(spark, table, 0).count() == 5
    with pytest.raises(S.SnapshotError):
        S.overwrite_snapshot(spark, spark.range(5), table, expected_rows=6)
    assert S.current_version(spark, table) == 1
    assert S.overwrite_snapshot(spark, spark.range(2), table) == 3  # the failed write keeps its number
    broken = put(tmp_path, "broken", "text where a table should be")
    with pytest.raises(Exception):
        S.ensure_table(spark, broken, L.RUNS_SCHEMA)
    assert open(broken).read() == "text where a table should be"
    with pytest.raises(ValueError):
        S.delete_exact(spark, S.version_path(spark, f"{tmp_path}/t", 0), f"{tmp_path}/raw")


def test_catalog(spark, tmp_path):
    place = f"{tmp_path}/wh"
    assert CAT.ensure_schema(spark, "est_a", place) == "CREATED"
    assert CAT.ensure_schema(spark, "est_a", place + "/ ") == "UNCHANGED"
    with pytest.raises(CAT.LocationConflict):
        CAT.ensure_schema(spark, "est_a", f"{tmp_path}/other")
    with pytest.raises(ValueError):
        CAT.ensure_schema(spark, "est_b", " / ")
    S.overwrite_snapshot(spark, spark.range(3), f"{place}/t")
    assert CAT.register_table(spark, "est_a", "t", S.version_path(spark, f"{place}/t", 0)) == "CREATED"
    S.overwrite_snapshot(spark, spark.range(4), f"{place}/t")
    assert CAT.register_table(spark, "est_a", "t", S.version_path(spark, f"{place}/t", 1)) == "REFRESHED"
    assert CAT.list_tables(spark, "est_a") == ["t"] and CAT.table_count(spark, "est_a", "t") == 4


def manifest_row(run, sha, at, status="SUCCESS"):
    return {"ingestion_run_id": run, "dataset_id": "d", "source_sha256": sha, "ingested_at_utc": at, "status": status,
            "raw_s3_key": f"raw/d/sha256={sha}/f.zip"}


def test_ledger(spark, tmp_path):
    ledger = I.Ledger(spark, f"{tmp_path}/ledger")
    for i, (run, status) in enumerate((("r1", "SUCCESS"), ("r2", "FAILED"), ("r3", "SUCCESS")), 1):
        ledger.start_run(run, f"t{i}a", False, {"marker": "m"}, 1)
        ledger.record(manifest_row(run, f"a{i}", f"t{i}"))
        ledger.record(manifest_row(run, f"a{i}", f"t{i}"))
        ledger.finish_run(run, f"t{i}b", status)
        assert ledger.active().first()["ingestion_run_id"] == ("r3" if run == "r3" else "r1")
    assert ledger.runs().count() == 3 and ledger.manifest().count() == 3
    first = ledger.runs().filter("ingestion_run_id = 'r1'").first()
    assert (first["start_time_utc"], first["source_data_carga_raw_final"]) == ("t1a", "m")
    # newest two distinct successful hashes are a3 and a1; the failed run's file and unknown names may go
    inventory = spark.createDataFrame([("d", f"raw/d/sha256={s}/f.zip") for s in ("a1", "a2", "a3")] + [("d", "raw/d/odd.zip")], "dataset_id string, raw_key string")
    plan = {r["raw_key"]: r["action"] for r in L.retention_plan(ledger.runs(), ledger.manifest(), inventory).collect()}
    assert [plan[f"raw/d/sha256={s}/f.zip"] for s in ("a1", "a2", "a3")] == ["PROTECTED", "CANDIDATE", "PROTECTED"]
    assert plan["raw/d/odd.zip"] == "CANDIDATE"
    assert L.branch_after_ingest(ledger.runs(), "r1").first()["branch"] == "TRANSFORM"
    assert L.branch_after_ingest(ledger.runs(), "r9").first()["branch"] == "ERROR_RUN_NOT_FOUND"
    assert L.branch_after_ingest(ledger.runs(), "r2").first()["branch"] == "ERROR_STATUS_FAILED"


def test_change_decision(spark):
    runs = spark.createDataFrame([("old", None)], "source_data_carga_raw_initial string, source_data_carga_raw_final string")
    intact = spark.createDataFrame([("d", None)], "dataset_id string, reason string")
    damaged = spark.createDataFrame([("d", "TABLE_EMPTY")], "dataset_id string, reason string")
    decide = lambda *a: tuple(L.change_decision(*a).first())
    assert decide(runs, "old", intact, True) == (False, "FORCED")
    assert decide(runs.filter("false"), "old", intact, False) == (False, "NO_PREVIOUS_SUCCESS")
    assert decide(runs, "new", intact, False) == (False, "MARKER_CHANGED")
    assert decide(runs, "old", damaged, False) == (False, "LOCAL_STATE_INCOMPLETE")
    assert decide(runs, "old", intact, False) == (True, "NO_CHANGE")


def test_ingest_run(spark, tmp_path):
    control = put(tmp_path, "c1.csv", "data_carga\n16/09/2026 06:32:11\n")
    newer = put(tmp_path, "c2.csv", "data_carga\n17/09/2026 06:32:11\n")
    source = put(tmp_path, "in.csv", "ID;V\n001;a\n002;b\n")
    raw = f"{tmp_path}/raw"
    sha = hashlib.sha256(open(source, "rb").read()).hexdigest()
    key = put(tmp_path, f"raw/d/sha256={sha}/in.zip", b"zip")
    ledger = I.Ledger(spark, f"{tmp_path}/ledger")
    datasets = [I.Dataset("d", source, "in.csv", f"{tmp_path}/bronze/d", "file:" + key)]
    go = lambda run, ctl, **k: I.run(spark, ledger, datasets, ctl, run, f"2026-{run}", raw, **k)
    assert go("r1", control) == "SUCCESS"
    rows = S.read_snapshot(spark, datasets[0].table)
    assert {r["ID"] for r in rows.collect()} == {"001", "002"} and rows.columns[-4:] == list(D.LINEAGE)
    assert go("r2", control) == "NO_CHANGE"
    assert go("r3", newer) == "SUCCESS"
    reused = ledger.manifest().filter("ingestion_run_id = 'r3' AND dataset_id = 'd'").first()
    assert reused["original_run_id"] == "r1" and "r1" in reused["reuse_reason"] and reused["retrieved_at_utc"] == "2026-r3"
    with pytest.raises(RuntimeError, match="marker changed"):
        go("r4", control, control_after=newer)
    put(tmp_path, "in.csv", "ID;V\n001;a;extra\n")
    with pytest.raises(D.ContractError):
        go("r5", control, force=True)
    states = {r["ingestion_run_id"]: r["status"] for r in ledger.runs().collect()}
    assert states == {"r1": "SUCCESS", "r2": "NO_CHANGE", "r3": "SUCCESS", "r4": "FAILED", "r5": "FAILED"}
    assert S.read_snapshot(spark, datasets[0].table).count() == 2  # the bad file was never published
    put(tmp_path, "raw/d/sha256=dead/in.zip", b"old")
    assert I.apply_retention(spark, ledger, raw, "r3", "now", dry_run=True) == "DRY_RUN"
    assert I.apply_retention(spark, ledger, raw, "r3", "now") == "EXECUTED"
    assert [r["raw_s3_key"].rsplit("/", 1)[1] for r in ledger.manifest().filter("retention_status = 'DELETED'").collect()] == []
    assert I.apply_retention(spark, ledger, raw, "r3", "now") == "NOOP"
    assert I.apply_retention(spark, ledger, raw, "r5", "now") == "SKIPPED"


# ---- several files of one input ------------------------------------------------------------------------

def _three(tmp_path, second):
    for name, text in (("a.csv", "ID;VAL\n1;x\n"), ("b.csv", second), ("c.csv", "﻿ID;VAL\n5;z\n")):
        (tmp_path / name).write_bytes(text.encode() if isinstance(text, str) else text)
    return str(tmp_path)


@pytest.mark.parametrize(
    ("second", "message"),
    [
        ("VAL;ID\nx;3\n", "other order"),
        ("ID\n3\n", r"missing \[VAL\]"),
        ("ID;VAL;MORE\n3;x;y\n", r"extra \[MORE\]"),
        (b"ID;VAL\n3;\x80\x81\n", "not valid UTF-8"),
        ("ID;VAL\n3;x\n4;y\n5\n6;w\n", r"b.csv, record 3: '5'"),
    ],
)
def test_every_file_keeps_the_contract(spark, tmp_path, second, message):
    path = _three(tmp_path / "in" if (tmp_path / "in").mkdir() is None else tmp_path, second)
    dataset = I.Dataset("d", path, "d.csv", str(tmp_path / "table"))
    with pytest.raises(D.ContractError, match=message):
        I.ingest_dataset(spark, dataset, "r", "t", "0" * 64)
    assert S.current_version(spark, dataset.table) is None


def test_quoted_names_and_marks_in_later_files_are_no_difference(spark, tmp_path):
    assert D.check_file(spark, _three(tmp_path, '﻿"ID" ; VAL\n3;"a\nb"\n')) == {"columns": ["ID", "VAL"], "logical_rows": 3}


def test_files_without_line_ends_in_fields_are_split_and_checked_for_quotes(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("ID;VAL\n" + "".join(f"{k};{'v' * 200}{k}\n" for k in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        rows = D.read_checked(spark, str(path), ["ID", "VAL"], multiline=False)
        assert rows.rdd.getNumPartitions() > 2 and sum(1 for r in rows.toLocalIterator() if r["VAL"].startswith("v")) == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    path.write_text('ID;VAL\n1;"a\nb"\n')
    with pytest.raises(D.ContractError, match="unbalanced quote"):
        D.checked_header(spark, str(path), multiline=False)


def test_one_input_file_becomes_several_output_files(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("ID;VAL\n" + "".join(f"{k};{hash(str(k))}{'v' * 100}{k * 7}\n" for k in range(30_000)))
    sizes = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    for key in sizes:
        spark.conf.set(key, "50k")
    try:
        dataset = I.Dataset("d", str(path), "d.csv", str(tmp_path / "table"))
        I.ingest_dataset(spark, dataset, "r", "t", "0" * 64)
    finally:
        for key in sizes:
            spark.conf.unset(key)
    assert len(S.read_snapshot(spark, dataset.table).inputFiles()) > 1


def test_control_timestamp_does_not_depend_on_the_session_zone(spark):
    from estrato.functions import parse_control_timestamp

    rows = spark.createDataFrame([("16/10/2011 00:30:00",), ("31/02/2026 10:00:00",), ("1/2/2020 10:00:00",), (" ",), ("16/10/2011 24:00:00",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        found = [r[0] for r in rows.select(parse_control_timestamp("t").cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == ["2011-10-16 00:30:00", None, None, None, None]


def test_fingerprint_follows_content_and_names_but_not_the_order_of_files(spark, tmp_path):
    def of(files):
        folder = tmp_path / str(len(list(tmp_path.iterdir())))
        for name, text in files.items():
            put(folder, name, text)
        return FS.text_fingerprint(spark, str(folder)).first()[0]

    base = of({"a": "1;x\n2;y\n", "b": "3;z\n"})
    assert base == of({"b": "3;z\n", "a": "1;x\n2;y\n"})
    others = [of({"a": "1;x\n2;z\n", "b": "3;z\n"}), of({"a": "1;x\n", "b": "2;y\n3;z\n"}), of({"a": "1;x\n2;y\n", "c": "3;z\n"}), of({"a": "1;x\n2;y\n2;y\n2;y\n", "b": "3;z\n"})]
    assert len({base, *others}) == 5
    assert FS.text_fingerprint(spark, put(tmp_path, "empty/x", "")).first()[0] is not None


def test_two_writers_of_one_version(spark, tmp_path):
    table = f"{tmp_path}/t"
    S.overwrite_snapshot(spark, spark.range(3), table)
    with pytest.raises(S.SnapshotError, match="another writer"):
        S._publish(spark, table, 0, "_v=0-late")
    assert S.read_snapshot(spark, table).count() == 3


def test_a_failed_run_does_not_become_the_active_version(spark, tmp_path):
    control = put(tmp_path, "c1.csv", "data_carga\n16/09/2026 06:32:11\n")
    newer = put(tmp_path, "c2.csv", "data_carga\n17/09/2026 06:32:11\n")
    source = put(tmp_path, "in.csv", "ID;V\n001;a\n")
    ledger = I.Ledger(spark, f"{tmp_path}/ledger")
    datasets = [I.Dataset("d", source, "in.csv", f"{tmp_path}/bronze/d", "raw")]
    I.run(spark, ledger, datasets, control, "r1", "t1")
    put(tmp_path, "in.csv", "ID;V\n001;a\n002;b\n")
    with pytest.raises(RuntimeError, match="marker changed"):
        I.run(spark, ledger, datasets, control, "r2", "t2", force=True, control_after=newer)
    assert S.read_snapshot(spark, datasets[0].table).count() == 2
    assert I.active_table(spark, ledger, datasets[0]).count() == 1


def test_ledger_entries_are_small_files_and_compaction_keeps_the_answer(spark, tmp_path):
    from estrato.sources import rowlog

    ledger = I.Ledger(spark, f"{tmp_path}/ledger")
    for k in range(6):
        ledger.start_run(f"r{k % 4}", f"t{k}", False, {"marker": f"m{k}"}, 1)
        ledger.record({"ingestion_run_id": f"r{k % 4}", "dataset_id": "d", "raw_s3_key": f"key{k}", "source_sha256": str(k)})
    assert len(ledger._runs._files()) == 6 and S.read_snapshot(spark, ledger.runs_path).count() == 0
    ledger.finish_run("r3", "end", "SUCCESS")
    ledger.mark_deleted(spark.createDataFrame([("key4",), ("none",)], "raw_s3_key string"), "now")
    want = {f"r{k % 4}": f"t{k}" for k in range(6)}, {"r0": "DELETED", "r1": "ACTIVE", "r2": "ACTIVE", "r3": "ACTIVE"}

    def state():
        return {r.ingestion_run_id: r.start_time_utc for r in ledger.runs().collect()}, {r.ingestion_run_id: r.retention_status for r in ledger.manifest().collect()}

    assert state() == want
    ledger.compact()
    assert state() == want and ledger._runs._files() == [] and S.read_snapshot(spark, ledger.runs_path).count() == 4
    # entries that compaction read but did not get to delete change nothing
    stale = spark.createDataFrame([("r0", "older", "RUNNING", True)], "ingestion_run_id string, start_time_utc string, status string, force boolean")
    stale.selectExpr("*", *[f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in L.RUNS_SCHEMA if f.name not in stale.columns], "5L as __moment", "'w' as __writer").write.mode("append").parquet(ledger._runs.entries)
    assert state() == want
    ledger.start_run("r0", "newest", False, None, 1)
    assert state()[0]["r0"] == "newest" and rowlog.COMPACT_AT > 10


def test_files_are_deleted_in_tasks_and_again(spark, tmp_path):
    keys = [put(tmp_path, f"raw/d{k}/f {k}.zip", "x") for k in range(20)]
    outside = put(tmp_path, "other/f", "x")
    rows = spark.createDataFrame([(f"file:{k}",) for k in keys] + [(f"file:{outside}",), (f"{tmp_path}/raw/../other/f",), (f"{tmp_path}/raw/d1",), (None,)], "raw_key string")
    found = S.materialize(spark, FS.delete_files(rows, f"{tmp_path}/raw", 4), f"{tmp_path}/out")
    assert {r["outcome"]: r["count"] for r in found.groupBy("outcome").count().collect()} == {"DELETED": 20, "REFUSED": 4}
    again = {r["outcome"]: r["count"] for r in FS.delete_files(rows, f"file:{tmp_path}/raw/").groupBy("outcome").count().collect()}
    assert again == {"ABSENT": 20, "REFUSED": 4} and open(outside).read() == "x"


def test_a_clustered_write_works_its_input_out_once_and_parts_a_value_that_fills_several_files(spark, tmp_path):
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    def mark(v):
        seen.add(1)
        return v

    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        # four years, one of them half of all rows, one NULL; texts that don't compress
        year = F.when(F.col("id") % 2 == 0, 2001).when(F.col("id") % 4 == 1, 2002).when(F.col("id") % 8 == 3, 2003)
        rows = spark.range(0, 20000, 1, 8).select(F.udf(mark, "long")("id").alias("id"), year.alias("year"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
        written = S.materialize(spark, rows, str(tmp_path / "t"), cluster=("year",))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert seen.value == 20000
    expected = spark.range(20000).select("id", year.alias("year"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    assert written.exceptAll(expected).isEmpty() and expected.exceptAll(written).isEmpty()
    files = written.groupBy(F.input_file_name().alias("file")).agg(F.count_distinct(F.coalesce("year", F.lit(0))).alias("years"), F.max("year").alias("year")).collect()
    assert sum(r["year"] == 2001 for r in files) > 1  # half of all rows is no task's or file's lot
    assert max(r["years"] for r in files) < 4
    for r in files:
        years = [x[0] for x in spark.read.parquet(r["file"]).select("year").collect()]
        assert years == sorted(years, key=lambda y: (y is not None, y))
