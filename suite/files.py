"""Text files written from the given tables and read back: records over lines, contracts per set of files, fingerprints, uploads."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from estrato.operators import profiling as P
from estrato.session import scratch_folder
from estrato.sources import catalog as CAT
from estrato.sources import delimited as D
from estrato.sources import files as FS
from estrato.sources import snapshots as S
from estrato.sources import splitting
from suite.profiles import profile_sql
from suite.raw_tables import table
from suite.registry import Registry


def _folder(s, what: str) -> str:
    return f"{scratch_folder(s)}/{what}-{uuid.uuid4().hex}"


ROWS_PER_FILE = 500_000
DOCUMENTS_PER_FILE = 10_000


def _with_header(df, columns, header: str, parts: int = 3, rows_per_file: int = ROWS_PER_FILE):
    """Lines of a text file per partition, the header first in each; at least `parts` files, more for more rows."""
    parts = max(parts, -(-df.count() // rows_per_file))
    lines = df.select(F.concat_ws(";", *columns).alias("value")).repartition(parts)

    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([header])], ["value"])
        for batch in batches:  # one schema for all
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string())], ["value"])

    return lines.mapInArrow(run, "value string")


def _quoted(column: str):
    return F.concat(F.lit('"'), F.replace(F.col(column), F.lit('"'), F.lit('""')), F.lit('"'))


def documents_read_back(s, d):
    """Whole texts with their line ends, quoted in semicolon text, read in blocks."""
    folder = _folder(s, "texts with line ends")
    docs = table(s, d, "documents")
    _with_header(docs, [F.col("doc_id").cast("string"), _quoted("text"), "lang", "source"], "doc_id;text;lang;source", rows_per_file=DOCUMENTS_PER_FILE).write.text(folder)
    names = D.checked_header(s, folder)
    return D.read_checked(s, folder, names).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", F.col(D.BROKEN).isNull().alias("whole"))


def record_numbers(s, d):
    """Records per file and the lines they cover, by number: none is lost or counted twice where blocks are cut."""
    folder = _folder(s, "numbered")
    docs = table(s, d, "documents")
    _with_header(docs, [F.col("doc_id").cast("string"), _quoted("text")], "doc_id;text", rows_per_file=DOCUMENTS_PER_FILE).write.text(folder)
    records = splitting.quoted_records(s, folder, ";").filter("record > 0")
    return records.agg(F.count("*").alias("n_records"), F.count_distinct("file_key", "record").alias("n_numbers"),
                       F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).alias("n_line_ends"))


# what a set of files is made to break, and what the check must say
OUTCOMES = {
    "sound": "OK", "quoted line ends": "OK", "blank name": "columns without a name", "repeated name": "repeated columns", "reserved name": "reserved columns",
    "wide record": "expected 3 fields", "narrow record": "expected 3 fields", "bytes": "not valid UTF-8", "other header": "header differs", "unbalanced": "unbalanced quote",
}


def contract_outcomes(s, d):
    """All orders as text under ten defects: (defect, outcome, rows read where the files are sound)."""
    orders = table(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("k"), F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("t"))
    odd = F.col("k").cast("long") % 50 == 0
    plain = ["k", "p", "t"]
    found = []
    for defect, said in OUTCOMES.items():
        header = {"blank name": "ID;;T", "repeated name": "ID;P;ID", "reserved name": "ID;P;__source_sha256"}.get(defect, "ID;P;T")
        columns = {
            "quoted line ends": ["k", F.concat(F.lit('"'), "p", F.lit('\n""'), "t", F.lit('""\n"')), "t"],
            "wide record": ["k", "p", F.when(odd, F.concat("t", F.lit(";more"))).otherwise(F.col("t"))],
            "narrow record": ["k", F.when(odd, F.col("p")).otherwise(F.concat("p", F.lit(";"), "t"))],
            "bytes": ["k", F.when(odd, F.unhex(F.lit("80")).cast("string")).otherwise(F.col("p")), "t"],
            "unbalanced": ["k", F.when(odd, F.concat(F.lit('"'), "p")).otherwise(F.col("p")), "t"],
        }.get(defect, plain)
        folder = _folder(s, "defect")
        _with_header(orders, columns, header).write.text(folder)
        if defect == "other header":
            _with_header(orders, ["p", "k", "t"], "P;ID;T", 1).write.mode("append").text(folder)
        try:
            report = D.check_file(s, folder, multiline=defect != "unbalanced")
            found.append((defect, "OK", report["logical_rows"]))
        except D.ContractError as error:
            found.append((defect, said if said in str(error) else str(error), None))
    return s.createDataFrame(found, "defect string, outcome string, n_rows bigint")


CONTRACT_SQL = " UNION ALL ".join(
    f"SELECT '{defect}' AS defect, '{said}' AS outcome, {'count(*)' if said == 'OK' else 'CAST(NULL AS BIGINT)'} AS n_rows FROM orders HAVING count(*) > 50" for defect, said in OUTCOMES.items())


def fingerprints(s, d):
    """Fingerprints of all orders as text, changed in one way each: does the value change?"""
    orders = table(s, d, "orders").select(F.concat_ws(";", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("value"), F.col("o_orderkey").alias("k")).orderBy("k")
    last = table(s, d, "orders").agg(F.max("o_orderkey")).first()[0]
    first = table(s, d, "orders").agg(F.min("o_orderkey")).first()[0]
    changed = {
        "same": orders, "two lines change places": orders.withColumn("k", F.when(F.col("k") == first, last).when(F.col("k") == last, first).otherwise(F.col("k"))),
        "a line end": orders.withColumn("value", F.when(F.col("k") == last, F.concat("value", F.lit("\r"))).otherwise(F.col("value"))),
        "a letter": orders.withColumn("value", F.when(F.col("k") == last, F.concat("value", F.lit("x"))).otherwise(F.col("value"))),
        "a line less": orders.filter(F.col("k") != last), "all lines turned round": orders.withColumn("k", -F.col("k")),
    }

    def of(rows) -> str:
        folder = _folder(s, "fingerprint")
        rows.orderBy("k").coalesce(1).select("value").write.text(folder)
        text = splitting.lines(s, folder).withColumn("name", F.lit("in.csv"))  # whatever Spark calls the file
        blocks = text.groupBy("file", "name", "size", "block").agg(F.count("*").alias("n"), F.min("at").alias("least"), *splitting.polynomial_sums(F.col("at"), F.col("value")))
        return splitting.file_fingerprints(blocks).select("fingerprint").first()[0]

    base = of(orders)
    rows = [(case, of(frame) != base) for case, frame in changed.items()]
    return s.createDataFrame(rows, "change string, is_seen boolean")


FINGERPRINT_SQL = """SELECT change, change <> 'same' AS is_seen FROM (SELECT unnest(['same', 'two lines change places', 'a line end', 'a letter', 'a line less', 'all lines turned round']) AS change)
 WHERE (SELECT count(DISTINCT o_orderkey) FROM orders) > 1"""


def report_through_view(s, d):
    """A profile written as a report of JSON lines, read back and asked through a named view."""
    folder = _folder(s, "report")
    S.write_report(P.column_profile(table(s, d, "documents"), ["doc_id", "text", "lang", "source"]), folder)
    name = f"report_{uuid.uuid4().hex}"
    CAT.define_view(s.read.schema("column_name string, total_rows bigint, distinct_count bigint, max_length int, distinct_pct double").json(folder), name)
    return s.sql(f"SELECT column_name, total_rows, distinct_count, max_length, distinct_pct FROM {name} WHERE total_rows > 0")


def uploads(s, d):
    """Keys to be stored against keys that are: even events arrive, those of three days in four are there, some with another size or content."""
    e, day = F.col("event_id"), F.col("event_id") % 4
    rows = table(s, d, "events").select(F.concat(F.lit("raw/"), "event_type", F.lit("/"), e.cast("string")).alias("raw_key"), e)
    incoming = rows.filter(e % 2 == 0).select("raw_key", (e % 100).alias("size"), F.concat(F.lit("s"), (e % 7).cast("string")).alias("sha256"))
    stored = rows.filter(day != 2).select("raw_key", F.when(e % 12 == 0, -1).otherwise(e % 100).alias("size"),
                                          F.when(e % 16 == 4, F.lit("other")).when(e % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), (e % 7).cast("string"))).alias("sha256"))
    return FS.classify_uploads(incoming, stored).select("raw_key", "status")


UPLOADS = """SELECT 'raw/' || event_type || '/' || CAST(event_id AS VARCHAR) AS raw_key, CASE WHEN event_id % 2 = 1 THEN 'STORED_ONLY' WHEN event_id % 4 = 2 THEN 'UPLOADED'
 WHEN event_id % 12 = 0 THEN 'CONFLICT' WHEN event_id % 16 = 4 THEN 'CONFLICT' ELSE 'ALREADY_EXISTS' END AS status FROM events"""


def register(reg: Registry) -> None:
    reg.add("records_with_quoted_line_ends", documents_read_back, "SELECT doc_id, text, lang, source, TRUE AS whole FROM documents")
    reg.add("records_numbered_in_blocks", record_numbers, """SELECT count(*) AS n_records, count(*) AS n_numbers,
        CAST(sum(length(text) - length(replace(text, chr(10), ''))) AS BIGINT) AS n_line_ends FROM documents WHERE text IS NOT NULL""")
    reg.add("file_contract_outcomes", contract_outcomes, CONTRACT_SQL)
    reg.add("changes_seen_by_fingerprint", fingerprints, FINGERPRINT_SQL)
    reg.add("profile_report_through_view", report_through_view,
            f"SELECT column_name, total_rows, distinct_count, max_length, distinct_pct FROM ({profile_sql('documents', ['doc_id', 'text', 'lang', 'source'])})")
    reg.add("upload_outcomes", uploads, UPLOADS)
