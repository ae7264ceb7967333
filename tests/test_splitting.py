"""Files cut into small blocks: records with line ends inside quotes, fingerprints, names of folders."""

import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from estrato.plans import ingest as I
from estrato.sources import delimited as D
from estrato.sources import files as FS
from estrato.sources import snapshots as S
from estrato.sources import splitting as X
from tests.test_sources import put

NAMES = ["ID", "A", "B"]


@contextmanager
def cut_at(spark, size):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, str(size))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def field(rng):
    plain = ["", "x", "é", 'in"side', " a ", "0012", "it's", ' "late']
    inside = ["", "a", "line\nbreak", "\n\n", '""', 'q"" ""', ";", ";\n;", "é\n", 'x"";\n""']
    return rng.choice(plain) if rng.random() < 0.5 else '"' + "".join(rng.choices(inside, k=rng.choice([1, 1, 3]))) + '"' + rng.choice(["", "", "", "tail"])


def content(rng, records, end, mark=""):
    rows = [f"{k};{field(rng)};{field(rng)}" + (";more" if rng.random() < 0.02 else "") for k in range(records)]
    rows = [x + rng.choice(["", "", "", "\n"]) for x in rows]  # blank lines between records
    return mark + "\n".join(['ID;"A";B', *rows]).replace("\n", end) + rng.choice(["", end])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def whole_file(spark, path):
    """Spark's own reader, a file a task."""
    schema = ", ".join(f"{n} string" for n in [*NAMES, D.BROKEN])
    return spark.read.options(**D._options(";"), header="true", enforceSchema="true", mode="PERMISSIVE", columnNameOfCorruptRecord=D.BROKEN).schema(schema).csv(path)


@pytest.mark.parametrize("end, mark, size", [("\n", "", 120), ("\r\n", "﻿", 150), ("\n", "﻿", 300), ("\r\n", "", 10_000)])
def test_same_rows_as_the_reader_of_whole_files(spark, tmp_path, end, mark, size):
    rng = random.Random(size)
    for k in range(2):
        put(tmp_path, f"f{k}.csv", content(rng, 40, end, mark))
    put(tmp_path, "g.csv", f'{mark}ID;A;B{end}1;"' + f"long {end}" * 60 + f'";2{end}3;"";4')  # a field over many blocks
    put(tmp_path, "h.csv", f'ID;A;B{end}1;"never closed{end}x;y{end}z')
    with cut_at(spark, size):
        assert size > 1000 or X.block_states(spark, str(tmp_path), ";").count() > 7
        got = rows_of(D.read_checked(spark, str(tmp_path), NAMES).select(*NAMES))
    assert got == rows_of(whole_file(spark, str(tmp_path)).select(*NAMES, D.BROKEN).drop(D.BROKEN))


def test_records_are_numbered_in_the_file(spark, tmp_path):
    path = put(tmp_path, "a.csv", "ID;A;B\n" + "".join(f'{k};"x\ny{k}";z\n\n' for k in range(60)) + "wrong;2\n5;6;7\n")
    with cut_at(spark, 90):
        got = X.quoted_records(spark, path, ";").collect()
        assert sorted(r.record for r in got) == list(range(63))
        assert {r.record: r.text for r in got}[7] == '6;"x\ny6";z'
        assert [(r.record, r.broken) for r in D.broken_records(spark, path, NAMES).collect()] == [(61, "wrong;2")]


def test_large_file_with_quoted_line_ends_is_read_in_many_tasks(spark, tmp_path):
    path = tmp_path / "big.csv"
    with open(path, "w") as out:
        out.write("ID;A;B\n")
        out.writelines(f'{k};"first line {k}\nsecond; ""line""";{"v" * 80}\n' for k in range(150_000))
    with cut_at(spark, 1 << 20):
        rows = D.read_checked(spark, str(path), NAMES)
        parts = rows.selectExpr("spark_partition_id() AS p", "A", D.BROKEN).groupBy("p").agg({"A": "count", D.BROKEN: "count"}).collect()
    assert len(parts) > 10 and sum(r["count(A)"] for r in parts) == 150_000 and sum(r[f"count({D.BROKEN})"] for r in parts) == 0


def fingerprint(spark, path):
    return FS.text_fingerprint(spark, str(path)).first()[0]


def test_fingerprint_sees_the_order_of_lines_and_their_ends(spark, tmp_path):
    base = '1;"a\nb"\n2;"c\nd"\n3;e\n'
    changed = ['1;"a\nd"\n2;"c\nb"\n3;e\n', '2;"c\nd"\n1;"a\nb"\n3;e\n', base.replace("\n", "\r\n"), base.replace("3;e\n", "3;e\r\n"), base[:-1], base + "\n", '1;"a\nb"\n2;"c\nd"\n3;f\n']
    seen = [fingerprint(spark, put(tmp_path, f"{k}/in.csv", text)) for k, text in enumerate([base, *changed])]
    assert len(set(seen)) == len(seen)
    assert fingerprint(spark, put(tmp_path, "again/in.csv", base)) == seen[0]
    assert fingerprint(spark, put(tmp_path, "again/other.csv", base)) != seen[0]


def test_fingerprint_does_not_depend_on_the_cuts(spark, tmp_path):
    rng = random.Random(1)
    lines = [f"{rng.randrange(30)};{'x' * rng.randrange(60)}" for _ in range(4000)]
    path = put(tmp_path, "in.csv", "\n".join(lines))
    put(tmp_path, "more.csv", "a\n")
    seen = set()
    for size in (300, 7000, 1 << 27):
        with cut_at(spark, size):
            seen.add(fingerprint(spark, tmp_path))
            report = D.line_report(spark, str(tmp_path))
            seen.add(FS.combined_fingerprint(report).first()[0])
    assert len(seen) == 1
    lines[1000], lines[3000] = lines[3000] + "y", lines[1000]
    put(tmp_path, "in.csv", "\n".join(lines))
    assert fingerprint(spark, tmp_path) not in seen and path


def test_swapped_values_are_loaded_and_not_reused(spark, tmp_path):
    control = put(tmp_path, "c.csv", "data_carga\n16/09/2026 06:32:11\n")
    newer = put(tmp_path, "c2.csv", "data_carga\n17/09/2026 06:32:11\n")
    source = put(tmp_path, "raw/in.csv", 'ID;V\n1;"a\nb"\n2;"c\nd"\n')
    ledger = I.Ledger(spark, f"{tmp_path}/ledger")
    datasets = [I.Dataset("d", source, "in.csv", f"{tmp_path}/bronze/d", "raw")]
    I.run(spark, ledger, datasets, control, "r1", "t1")
    put(tmp_path, "raw/in.csv", 'ID;V\n1;"a\nd"\n2;"c\nb"\n')
    I.run(spark, ledger, datasets, newer, "r2", "t2")
    assert sorted(tuple(r) for r in I.active_table(spark, ledger, datasets[0]).select("ID", "V").collect()) == [("1", "a\nd"), ("2", "c\nb")]
    assert ledger.manifest().filter("dataset_id = 'd' AND ingestion_run_id = 'r2'").first()["reuse_reason"] is None


@pytest.mark.parametrize("folder", ["com espaço", "50% a+b", "x%20ç#1"])
def test_any_folder_name(spark, tmp_path, folder):
    put(tmp_path, f"{folder}/a b.csv", 'ID;A;B\n1;"x\ny";z\n')
    put(tmp_path, f"{folder}/ç.csv", "ID;A;B\n2;x;z\n")
    assert D.check_file(spark, f"{tmp_path}/{folder}") == {"columns": NAMES, "logical_rows": 2}
    put(tmp_path, f"{folder}/ç.csv", "ID;A;B\n2;x\n")
    with pytest.raises(D.ContractError, match="ç.csv, record 1: '2;x'"):
        D.check_file(spark, f"{tmp_path}/{folder}")
    put(tmp_path, f"{folder}/ç.csv", "ID;A;C\n2;x\n")
    with pytest.raises(D.ContractError, match="missing"):
        D.checked_header(spark, f"{tmp_path}/{folder}")


def test_scratch_goes_when_asked(tmp_path):
    from estrato.session import scratch_folder, shared_folder

    class Context:
        master, applicationId = "spark://host", "app-1"

    class Conf(dict):
        pass

    class Session:
        sparkContext = Context
        conf = Conf({"spark.sql.warehouse.dir": "file:/local/warehouse"})

    with pytest.raises(ValueError, match="share"):
        shared_folder(Session)
    Session.conf = Conf({"spark.sql.warehouse.dir": "file:/local/warehouse", "spark.checkpoint.dir": "hdfs://a/b/"})
    assert scratch_folder(Session) == "hdfs://a/b/estrato-app-1"


def test_more_rows_are_written_as_more_files(spark):
    from suite import files

    rows = spark.range(100).select(F.col("id").cast("string").alias("k"))
    assert files._with_header(rows, ["k"], "K").rdd.getNumPartitions() == 3
    assert files._with_header(rows, ["k"], "K", rows_per_file=10).rdd.getNumPartitions() == 10
