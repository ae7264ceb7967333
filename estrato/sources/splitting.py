"""Text files cut where Spark cuts them, with what must be known across the cuts.

Fingerprint: a file's lines h0, h1, .. stand for the polynomial sum of h_i * B**i modulo a prime. A block's
sum, from the places its lines have in the task that reads it, times a power of B is its part of the file's, so blocks
are summed where they are read and put together by one row each, and the value doesn't depend on the cuts.

Quoted line ends: whether a line begins a record depends on all quotes before it. A line maps the state before
it (between records, or inside a quoted field) to the state behind it. Such maps compose, so each block
is mapped as a whole, one row a block gives the state that every block begins in, and then the
blocks are cut into records independently. Records that lie in several blocks are put together by number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from estrato.session import new_folder

PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1540483477, 1103515245, 1664525003, 1299709271)
DIGIT, DIGITS = 8, 5
"""Exponents below 2**40 are taken apart into digits of 8 bits, whose powers are looked up."""
ROW_BITS = 33
"""monotonically_increasing_id holds the row in its task in this many bits."""

RECORD, QUOTED = 0, 1
"""States between two lines: a record begins, or a quoted field goes on."""


def pinned_splits(spark: SparkSession) -> None:
    """From here on files are cut alike in every pass, also when executors come and go."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


def decoded_path(column: str = "_metadata.file_path") -> Column:
    """The path as it is written: Spark gives it percent-encoded."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, block, at, value): lines without their line feed; at rises by one from line to line of a block."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().bitwiseAND((1 << ROW_BITS) - 1).alias("at"), "value")


def _power(exponent: Column, lane: int) -> Column:
    """BASES[lane] to the power of `exponent`, modulo the prime."""
    prime, out = PRIMES[lane], None
    for digit in range(DIGITS):
        step = pow(BASES[lane], 1 << (DIGIT * digit), prime)
        values, value = [], 1
        for _ in range(1 << DIGIT):
            values.append(str(value))
            value = value * step % prime
        held = F.expr(f"cast(split('{','.join(values)}', ',') as array<bigint>)")  # folded to one constant
        factor = F.get(held, F.shiftright(exponent, DIGIT * digit).bitwiseAND((1 << DIGIT) - 1).cast("int"))
        out = factor if out is None else out * factor % prime
    return out


def polynomial_sums(at: Column, value: Column) -> list[Column]:
    """Aggregates sum0 .. of a block's lines, as they stand in their task."""
    # the powers by the low digits repeat from line to line; each lane has its own hash of the line
    return [F.sum(F.pmod(F.xxhash64(value, F.lit(k)), F.lit(p)) * _power(at, k) % p).alias(f"sum{k}") for k, p in enumerate(PRIMES)]


def file_fingerprints(blocks: DataFrame) -> DataFrame:
    """(file, name, size, lines, fingerprint) from (file, name, size, block, n, least, sum0 ..), a row per block."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("least"))
    parts = [F.pmod(F.sum(F.pmod(F.col(f"sum{k}"), F.lit(p)) * _power(F.pmod(F.col("shift"), F.lit(p - 1)), k) % p), F.lit(p)).cast("string").alias(f"part{k}") for k, p in enumerate(PRIMES)]
    found = placed.groupBy("file", "name", "size").agg(F.sum("n").alias("lines"), *parts)
    whole = F.concat_ws("|", "name", F.col("size").cast("string"), F.col("lines").cast("string"), *[f"part{k}" for k in range(len(PRIMES))])
    return found.select("file", "name", "size", "lines", F.sha2(whole, 256).alias("fingerprint"))


# ---- records with quoted line ends -------------------------------------------------------------------


def line_rules(delimiter: str, quote: str = '"') -> tuple[re.Pattern, re.Pattern]:
    """Patterns of lines that end between records, when begun so and when begun inside a quoted field.

    A field is quoted if its first character is the quote; a doubled quote inside stands for one. What
    follows a closing quote up to the delimiter belongs to the field.
    """
    d, q = re.escape(delimiter.encode()), re.escape(quote.encode())
    inside = b"(?:[^" + q + b"]|" + q + q + b")*+" + q + b"[^" + d + b"]*+"
    field = b"(?:" + q + inside + b"|[^" + q + d + b"][^" + d + b"]*+|)"
    more = b"(?:" + d + field + b")*+"
    return re.compile(field + more, re.DOTALL), re.compile(inside + more, re.DOTALL)


def _maps(values: pa.Array, delimiter: str, first: bool) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(numbers of lines with quotes, what each maps the two states to)."""
    quoted = np.flatnonzero(pc.match_substring(values, b'"' if pa.types.is_binary(values.type) else '"').to_numpy(zero_copy_only=False))
    from_record, from_quoted = line_rules(delimiter)
    out = []
    for i, line in zip(quoted.tolist(), values.take(pa.array(quoted)).cast(pa.binary()).to_pylist()):
        line = line[3:] if first and i == 0 and line.startswith(b"\xef\xbb\xbf") else line
        line = line.removesuffix(b"\r")
        out.append((RECORD if from_record.fullmatch(line) else QUOTED, RECORD if from_quoted.fullmatch(line) else QUOTED))
    return quoted, out


def _states(n: int, quoted: np.ndarray, maps: list[tuple[int, int]], state: int) -> tuple[np.ndarray, int]:
    """(state before each line, state behind the last)."""
    before, at = np.empty(n, np.int8), 0
    for i, step in zip(quoted.tolist(), maps):
        before[at : i + 1] = state
        state, at = step[state], i + 1
    before[at:] = state
    return before, state


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """(file key, block, first, end) of consecutive lines of one block."""
    key, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    cuts = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1 if len(key) else []
    bounds = [0, *cuts, len(key)]
    for a, b in zip(bounds, bounds[1:]):
        if b > a:
            yield int(key[a]), int(block[a]), a, b


def _block_maps(delimiter: str):
    """A row per block: what it maps the two states to, the records that begin in it from either, and whether its first line ends with a carriage return."""
    schema = pa.schema([("file_key", pa.int64()), ("block", pa.int64()), ("to0", pa.int8()), ("to1", pa.int8()), ("begin0", pa.int64()), ("begin1", pa.int64()), ("carriage", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in batches:
            for key, block, a, b in _runs(batch):
                values = batch.column(2).slice(a, b - a)
                if (key, block) != at:
                    if held:
                        yield pa.RecordBatch.from_pylist([held], schema)
                    at = key, block
                    carriage = bool((values[0].as_py() or b"").endswith(b"\r"))
                    held = {"file_key": key, "block": block, "to0": RECORD, "to1": QUOTED, "begin0": 0, "begin1": 0, "carriage": carriage}
                    first = block == 0
                quoted, maps = _maps(values, delimiter, first)
                first = False
                some = _filled(values)
                for start in (RECORD, QUOTED):
                    before, held[f"to{start}"] = _states(len(values), quoted, maps, held[f"to{start}"])
                    held[f"begin{start}"] += int(((before == RECORD) & some).sum())
        if held:
            yield pa.RecordBatch.from_pylist([held], schema)

    return run


def _filled(values: pa.Array) -> np.ndarray:
    """Lines that are more than a line end."""
    size = pc.binary_length(values).to_numpy(zero_copy_only=False)
    return (size > 1) | (size == 1) & (pc.equal(values, pa.scalar(b"\r", values.type)).to_numpy(zero_copy_only=False) == False)  # noqa: E712


def _cut(delimiter: str, known: dict[tuple[int, int], tuple[int, int, bool]]):
    """Records and pieces of records: (file_key, record, block, whole, text). `known`: per block its state, first record's number, carriage returns."""
    schema = pa.schema([("file_key", pa.int64()), ("record", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, number, left, lead, carriage = None, RECORD, 0, [], False, False

        def rest(closed: bool) -> Iterator[pa.RecordBatch]:
            """What is open; it is whole if its head lies in this block and its end does too."""
            if left:
                whole = not lead and (closed or state == RECORD)
                yield pa.RecordBatch.from_pylist([{"file_key": at[0], "record": number, "block": at[1], "whole": whole, "text": b"\n".join(left).decode(errors="replace")}], schema)

        for batch in batches:
            for key, block, a, b in _runs(batch):
                values = batch.column(2).slice(a, b - a)
                first = (key, block) != at
                if first:
                    yield from rest(False)
                    at = key, block
                    if at not in known:
                        raise RuntimeError("files are cut otherwise than in the pass before; were they changed?")
                    state, number, carriage = known[at]
                    lead, left, number = state == QUOTED, [], number - 1
                quoted, maps = _maps(values, delimiter, first and block == 0)
                before, after = _states(len(values), quoted, maps, state)
                begins = (before == RECORD) & _filled(values)
                kept = np.flatnonzero(begins | (before == QUOTED))
                body = values.take(pa.array(kept)).cast(pa.binary())
                if carriage:
                    body = pa.array([x.removesuffix(b"\r") for x in body.to_pylist()], pa.binary())
                heads = np.flatnonzero(begins[kept])
                # lines before the first head go on with what is open; the last record stays open
                cut = int(heads[0]) if len(heads) else len(kept)
                left += body.slice(0, cut).to_pylist()
                if len(heads):
                    yield from rest(True)
                    lead = False
                    texts = body.slice(cut).to_pylist()
                    bounds = [*(heads - cut).tolist(), len(texts)]
                    done = [texts[x] if y == x + 1 else b"\n".join(texts[x:y]) for x, y in zip(bounds[:-2], bounds[1:-1])]
                    numbers = np.arange(number + 1, number + 1 + len(done), dtype=np.int64)
                    if done:
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(done), key, np.int64)), pa.array(numbers), pa.array(np.full(len(done), block, np.int64)), pa.array(np.ones(len(done), bool)),
                                                          pa.array([x.decode(errors="replace") for x in done], pa.string())], schema=schema)
                    number += len(heads)
                    left = texts[bounds[-2] :]
                state = after
        yield from rest(False)

    return run


def block_states(spark: SparkSession, path: str, delimiter: str) -> DataFrame:
    """(file_key, block, state, first_record, carriage): where each block of the files begins. One row a block, stored."""
    pinned_splits(spark)
    text = lines(spark, path).select(F.xxhash64("file").alias("file_key"), "block", F.col("value").cast("binary").alias("value"))
    maps = text.mapInArrow(_block_maps(delimiter), "file_key long, block long, to0 byte, to1 byte, begin0 long, begin1 long, carriage boolean")
    folder = new_folder(spark, "block-maps")
    maps.write.parquet(folder)
    order = Window.partitionBy("file_key").orderBy("block")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(F.when((F.col("to0") == QUOTED) & (F.col("to1") == RECORD), 1).otherwise(0)).over(past), F.lit(0))
    blocks = spark.read.parquet(folder).withColumn("turned", turned).withColumn("turned_behind", F.lead("turned").over(order))
    # the last block before that ends in one state whatever came before it, and the turns since
    fixed = F.last(F.when(F.col("to0") == F.col("to1"), F.struct(F.col("to0").alias("to"), F.col("turned_behind").alias("turned"))), ignorenulls=True).over(past)
    state = F.pmod(F.coalesce(F.expr("fixed.to"), F.lit(RECORD)).cast("int") + F.col("turned") - F.coalesce(F.expr("fixed.turned"), F.lit(0)), F.lit(2)).cast("int")
    blocks = blocks.withColumn("fixed", fixed).withColumn("state", state)
    begin = F.when(F.col("state") == RECORD, F.col("begin0")).otherwise(F.col("begin1"))
    return blocks.select("file_key", "block", "state", F.coalesce(F.sum(begin).over(past), F.lit(0)).alias("first_record"), F.first("carriage").over(order).alias("carriage"))


def quoted_records(spark: SparkSession, path: str, delimiter: str) -> DataFrame:
    """(file_key, record, text) of all files, records numbered from 0 (the header) in each; blank lines are none.

    Files are cut into blocks as lines are; line ends inside quotes stay in the record, written as a line
    feed in files whose lines end with both characters. file_key is xxhash64 of the path as Spark gives it.
    The driver holds one small entry a block, as its scheduler does.
    """
    starts = block_states(spark, path, delimiter)
    known = {(r.file_key, r.block): (r.state, r.first_record, r.carriage) for r in starts.toLocalIterator()}
    crossing = any(state == QUOTED for state, _, _ in known.values())
    sent = spark.sparkContext.broadcast(known)
    text = lines(spark, path).select(F.xxhash64("file").alias("file_key"), "block", F.col("value").cast("binary").alias("value"))
    found = text.mapInArrow(lambda batches: _cut(delimiter, sent.value)(batches), "file_key long, record long, block long, whole boolean, text string")
    if not crossing:
        return found.select("file_key", "record", "text")
    pieces = found.filter(~F.col("whole")).groupBy("file_key", "record").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("of"))
    joined = pieces.select("file_key", "record", F.array_join(F.col("of.text"), "\n").alias("text"))
    return found.filter("whole").select("file_key", "record", "text").union(joined)
