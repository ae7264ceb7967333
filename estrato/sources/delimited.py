"""Strict reading of semicolon-separated text, with its contract checked on Spark.

Files are checked as DataFrames: one row per finding, and every file of the input is looked at. Files
are read in blocks, those with line ends inside quotes too (see splitting.py); a source whose fields
hold no line ends says so (``multiline=False``) and saves the pass that finds where records begin.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.session import new_folder
from estrato.sources import splitting

# Reserved lineage names, in order, and the text layout.
LINEAGE = ("__ingested_at_utc", "__ingestion_run_id", "__source_file", "__source_sha256")
DELIMITER = ";"
BOM = "﻿"
BROKEN = "__broken_record"


class ContractError(ValueError):
    """A file does not keep its contract."""


def _options(delimiter: str, multiline: bool = True, columns: int = 0) -> dict[str, str]:
    return {
        "sep": delimiter, "quote": '"', "escape": '"', "multiLine": str(multiline).lower(), "emptyValue": "",
        "encoding": "UTF-8", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
        # a record may be wide or long; nothing is cut short. `columns` is what the widest line holds
        "maxColumns": str(max(20480, 2 * columns)), "maxCharsPerColumn": "-1",
    }


def line_report(spark: SparkSession, path: str, delimiter: str = DELIMITER) -> DataFrame:
    """One row per file, from one pass: first line, bad lines, the widest one, and the content's fingerprint.

    Columns: file, first_line (byte-order mark removed), invalid_lines (bytes that are not UTF-8),
    odd_quote_lines (an unbalanced quote: a field goes on in the next line), widest (fields), name, fingerprint.
    """
    text = splitting.lines(spark, path).withColumn("name", F.element_at(F.split(splitting.decoded_path("file"), "/"), -1))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    fields = F.length("value") - F.length(F.replace("value", F.lit(delimiter), F.lit(""))) + 1
    blocks = text.groupBy("file", "name", "size", "block").agg(
        F.count("*").alias("n"), F.min("at").alias("least"), F.min_by("value", "at").alias("first_line"),
        F.count_if(~F.is_valid_utf8("value")).alias("invalid_lines"), F.count_if(quotes % 2 == 1).alias("odd_quote_lines"), F.max(fields).alias("widest"),
        *splitting.polynomial_sums(F.col("at"), F.col("value")),
    )
    folder = new_folder(spark, "blocks")
    blocks.write.parquet(folder)  # a row a block; fingerprint and report are both made of it
    blocks = spark.read.schema(blocks.schema).parquet(folder)
    report = blocks.groupBy("file").agg(
        F.regexp_replace(F.regexp_replace(F.min_by("first_line", "block"), "^" + BOM, ""), "\r$", "").alias("first_line"),
        F.sum("invalid_lines").alias("invalid_lines"), F.sum("odd_quote_lines").alias("odd_quote_lines"), F.max("widest").alias("widest"),
    )
    return report.join(splitting.file_fingerprints(blocks).select("file", "name", "fingerprint"), "file").withColumn("file", splitting.decoded_path("file"))


def _names(line: Column, delimiter: str) -> Column:
    return F.transform(F.split(line, re.escape(delimiter), -1), lambda n: F.trim(F.regexp_replace(F.trim(n), '^"(.*)"$', "$1")))


def file_findings(report: DataFrame, delimiter: str = DELIMITER, multiline: bool = True) -> DataFrame:
    """(file, finding) for every file whose header differs from the first file's or whose text is broken.

    ``report`` comes from line_report; the first file is the one with the smallest path. Header names
    are compared one by one, in order, without quotes and outer spaces.
    """
    head = report.agg(F.min("file").alias("first_file"), F.min_by("first_line", "file").alias("wanted"))
    own, wanted = _names(F.col("first_line"), delimiter), _names(F.col("wanted"), delimiter)
    missing, extra = F.array_except(wanted, own), F.array_except(own, wanted)
    header = F.when(own == wanted, F.lit(None)).otherwise(F.concat(
        F.lit("header differs from "), F.col("first_file"), F.lit(": missing ["), F.array_join(missing, ", "),
        F.lit("], extra ["), F.array_join(extra, ", "), F.lit("]"),
        F.when((F.size(missing) == 0) & (F.size(extra) == 0), F.lit(", other order or number")).otherwise(F.lit("")),
    ))
    invalid = F.when(F.col("invalid_lines") > 0, F.concat(F.col("invalid_lines").cast("string"), F.lit(" lines with bytes that are not valid UTF-8")))
    quotes = F.when(F.col("odd_quote_lines") > 0, F.concat(F.col("odd_quote_lines").cast("string"), F.lit(" lines with an unbalanced quote")))
    found = [header, invalid] if multiline else [header, invalid, quotes]
    # one row against one row per file
    return report.crossJoin(F.broadcast(head)).select("file", F.explode(F.array_compact(F.array(*found))).alias("finding"))


def read_header(spark: SparkSession, path: str, delimiter: str = DELIMITER, report: DataFrame | None = None) -> list[str]:
    """Column names of the first record of the first file, mark and outer spaces removed. One record travels."""
    report = line_report(spark, path, delimiter) if report is None else report
    head = report.agg(F.min("file"), F.min_by("first_line", "file")).first()
    if head[0] is None:
        raise ContractError(f"{path} is empty")
    record = head[1]
    if not splitting.line_rules(delimiter)[0].fullmatch(record.encode()):  # a name holds a line end
        key = splitting.lines(spark, path).filter(splitting.decoded_path("file") == head[0]).select(F.xxhash64("file")).first()[0]
        record = splitting.quoted_records(spark, path, delimiter).filter((F.col("file_key") == key) & (F.col("record") == 0)).first()["text"].lstrip(BOM)
    names = next(csv.reader(io.StringIO(record, newline=""), delimiter=delimiter), [])
    return [v.strip().lstrip(BOM) for v in names]


def header_findings(names: Sequence[str], reserved: Sequence[str] = LINEAGE) -> list[str]:
    """What is wrong with a header: blank, repeated or reserved names."""
    found = []
    blank = [i for i, n in enumerate(names) if not n]
    if not names or (len(names) == 1 and blank):
        return ["header is empty"]
    if blank:
        found.append(f"columns without a name at {blank}")
    repeated = sorted({n for n in names if n and names.count(n) > 1})
    if repeated:
        found.append(f"repeated columns {repeated}")
    taken = [n for n in names if n in reserved]
    if taken:
        found.append(f"reserved columns {taken}")
    return found


def _parsed(spark: SparkSession, path: str, header: Sequence[str], delimiter: str, mode: str = "PERMISSIVE") -> DataFrame:
    """(file_key, record, fields..) of every record but the headers, with line ends inside quotes; BROKEN as in read_checked."""
    fields = [T.StructField(n, T.StringType(), True) for n in header]
    schema = T.StructType([*fields, T.StructField(BROKEN, T.StringType(), True)] if mode == "PERMISSIVE" else fields)
    options = {**_options(delimiter, False, len(header)), "mode": mode, "columnNameOfCorruptRecord": BROKEN}
    records = splitting.quoted_records(spark, path, delimiter).filter("record > 0")
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    return records.select("file_key", "record", F.from_csv("text", ddl, options).alias("fields")).select("file_key", "record", "fields.*")


def read_checked(spark: SparkSession, path: str, header: Sequence[str], delimiter: str = DELIMITER, multiline: bool = True) -> DataFrame:
    """All-text rows plus the raw text of records whose width differs from the header (else NULL).

    Counting or selecting few columns would let the parser skip the width check, so callers use
    the mark column together with the whole row.
    """
    if multiline:
        return _parsed(spark, path, header, delimiter).drop("file_key", "record")
    fields = [T.StructField(n, T.StringType(), True) for n in header]
    schema = T.StructType([*fields, T.StructField(BROKEN, T.StringType(), True)])
    return (
        spark.read.options(**_options(delimiter, multiline, len(header)), header="true", enforceSchema="true", mode="PERMISSIVE",
                           columnNameOfCorruptRecord=BROKEN)
        .schema(schema).csv(path)
    )


def broken_records(spark: SparkSession, path: str, header: Sequence[str], delimiter: str = DELIMITER) -> DataFrame:
    """(file, record, broken): the first record of a wrong width of each file and its number, from 1."""
    rows = _parsed(spark, path, header, delimiter)
    # every column is measured and the result used, so that the parser reads the whole record
    whole = reduce(lambda x, y: x + y, [F.coalesce(F.length(c), F.lit(0)) for c in header])
    first = rows.withColumn("__all", whole).filter(F.col(BROKEN).isNotNull() & (F.col("__all") >= 0)).groupBy("file_key").agg(F.min("record").alias("record"), F.min_by(BROKEN, "record").alias("broken"))
    files = splitting.lines(spark, path).select("file").distinct().select(splitting.decoded_path("file").alias("file"), F.xxhash64("file").alias("file_key"))
    return first.join(files, "file_key").select("file", "record", "broken")


def read_delimited_strict(spark: SparkSession, path: str, header: Sequence[str], delimiter: str = DELIMITER) -> DataFrame:
    """All-text rows; the first record of a wrong width fails the job."""
    return _parsed(spark, path, header, delimiter, "FAILFAST").drop("file_key", "record")


def width_report(rows: DataFrame) -> DataFrame:
    """Logical records, broken ones, the smallest broken text and the characters read.

    ``rows`` comes from read_checked.
    """
    columns = [c for c in rows.columns if c != BROKEN]
    # every column is measured, so that the parser reads the whole record
    length = reduce(lambda x, y: x + y, [F.coalesce(F.length(c), F.lit(0)) for c in columns])
    return rows.agg(
        F.count("*").alias("logical_rows"),
        F.count(BROKEN).alias("broken_rows"),
        F.min(BROKEN).alias("first_broken"),
        F.sum(length.cast("bigint")).alias("text_length"),
    )


def checked_header(spark: SparkSession, path: str, delimiter: str = DELIMITER, reserved: Sequence[str] = LINEAGE, multiline: bool = True, report: DataFrame | None = None) -> list[str]:
    """The header that all files of the input share; ContractError names every file that breaks the contract."""
    report = line_report(spark, path, delimiter) if report is None else report
    names = read_header(spark, path, delimiter, report)
    found = header_findings(names, reserved)
    if found:
        raise ContractError(f"{path}: {'; '.join(found)}")
    broken = file_findings(report, delimiter, multiline).orderBy("file", "finding")
    if not broken.isEmpty():
        summary = broken.groupBy().agg(F.count_distinct("file").alias("files"), F.min(F.struct("file", "finding")).alias("first")).first()
        raise ContractError(f"{summary['files']} files break the contract; {summary['first']['file']}: {summary['first']['finding']}")
    return names


def first_broken(spark: SparkSession, path: str, header: Sequence[str], delimiter: str = DELIMITER) -> str:
    """The first record of a wrong width in words; for the message of an error."""
    row = broken_records(spark, path, header, delimiter).orderBy("file").first()
    return "" if row is None else f"{row['file']}, record {row['record']}: {row['broken']!r}"


def check_file(spark: SparkSession, path: str, delimiter: str = DELIMITER, reserved: Sequence[str] = LINEAGE, multiline: bool = True) -> dict:
    """Full contract check of all files: header, text encoding, record widths. Raises ContractError, else a summary."""
    names = checked_header(spark, path, delimiter, reserved, multiline)
    rows = read_checked(spark, path, names, delimiter)
    report = width_report(rows).first()
    if report["broken_rows"]:
        raise ContractError(f"{path}: expected {len(names)} fields, broken record in {first_broken(spark, path, names, delimiter)}")
    return {"columns": names, "logical_rows": report["logical_rows"]}


def add_lineage(df: DataFrame, ingested_at: str, run_id: str, source_file: str, sha256: str) -> DataFrame:
    values = dict(zip(LINEAGE, (ingested_at, run_id, source_file, sha256)))
    return df.withColumns({name: F.lit(value).cast("string") for name, value in values.items()})


# ---- the control file ------------------------------------------------------------------------------

CONTROL_COLUMN = "data_carga"


def control_report(spark: SparkSession, path: str, column: str = CONTROL_COLUMN, delimiter: str = DELIMITER) -> DataFrame:
    """One row: (status, marker, marker_at). Anything but one column and one record has its own status."""
    from estrato.functions import parse_control_timestamp

    lines = spark.read.text(path, wholetext=True).select(
        F.regexp_replace("value", "^" + BOM, "").alias("body"), F.is_valid_utf8("value").alias("valid")
    )
    # empty lines are no records; a control file is a few bytes, so one row holds it
    cut = lines.select(
        "valid", F.filter(F.split("body", "\r\n|\n|\r"), lambda line: line != "").alias("records")
    ).select(
        "valid", "records",
        F.transform(F.split(F.coalesce(F.get("records", F.lit(0)), F.lit("")), F.lit(delimiter), -1), F.trim).alias("names"),
        F.split(F.coalesce(F.get("records", F.lit(1)), F.lit("")), F.lit(delimiter), -1).alias("values"),
    )
    wanted = F.filter("names", lambda n: n == column)
    raw = F.trim(F.regexp_replace(F.get("values", F.lit(0)), '^"(.*)"$', "$1"))
    status = (
        F.when(~F.col("valid"), "INVALID_TEXT")
        .when(F.size("records") == 0, "EMPTY_FILE")
        .when((F.size("names") == 1) & (F.get("names", F.lit(0)) == ""), "EMPTY_HEADER")
        .when(F.size(wanted) > 1, "DUPLICATE_COLUMN")
        .when(F.size(wanted) == 0, "MISSING_COLUMN")
        .when(F.size("names") > 1, "EXTRA_COLUMN")
        .when(F.size("records") == 1, "NO_ROWS")
        .when(F.size("values") != 1, "WIDE_ROW")
        .when(raw == "", "BLANK_MARKER")
        .when(parse_control_timestamp(raw).isNull(), "INVALID_MARKER")
        .when(F.size("records") > 2, "EXTRA_ROWS")
        .otherwise("OK")
    )
    ok = F.col("status") == "OK"
    return cut.select(status.alias("status"), raw.alias("marker")).select(
        "status", F.when(ok, F.col("marker")).alias("marker"),
        F.when(ok, parse_control_timestamp("marker")).alias("marker_at"),
    )


def read_control(spark: SparkSession, path: str, column: str = CONTROL_COLUMN) -> tuple:
    row = control_report(spark, path, column).first()
    status = "EMPTY_FILE" if row is None else row["status"]
    if status != "OK":
        raise ContractError(f"control file {path}: {status}")
    return row["marker"], row["marker_at"]


