"""Filter interaction audit: what each filter of a chain removes, in every order of the filters.

A row's failures are bits. Conditions on the text alone are computed where the row is read. Copies of an
earlier document are found by an existential self-join: a left-semi join on hash, exact text and smaller
doc_id. The ids it marks are united with the other failures, one narrow row each, and a bitwise or by id
gives each row's combination. There are few combinations, so every order of the filters is evaluated on
their counts and not on rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import stored

WORDS_AT_LEAST = 50
DISTINCT_PERCENT = 65
CAPITALS_PERCENT = 5
SYMBOLS = r"[#$%&*|]"
ROWS_PER_SALT = 500
"""Rows of one repeated text that are compared in one place; more of them are dealt over several."""
SENT_ROUND = 1 << 20
"""Repeated hashes up to this number (16 MB) are sent to all tasks; more of them are joined by a shuffle."""
COPIES = "E"


def text_conditions(text: Column) -> dict[str, Column]:
    """The failure conditions on a text that is not NULL, by filter letter."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n < WORDS_AT_LEAST,
        "B": 100 * distinct < DISTINCT_PERCENT * n,
        "C": F.lit(100).cast("long") * capitals > CAPITALS_PERCENT * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    part = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), text.alias("text"), F.xxhash64(text).alias("h"))


def later_copies(rows: DataFrame) -> DataFrame:
    """(doc_id, part, h) of the rows (doc_id, part, text, h) whose text a smaller doc_id also has.

    Rows without doc_id are no copies and have none. Only texts whose hash repeats travel; of each the
    least doc_id per task. A text repeated very often is looked up in as many places as its rows need.
    """
    rows = rows.filter("doc_id IS NOT NULL")
    seen = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("last"))
    salts = F.expr(f"cast(n div {ROWS_PER_SALT} + 1 as int)").alias("salts")
    shared = stored(seen.filter("least < last").select("h", "least", salts), "shared-hashes")
    few = shared.count() <= SENT_ROUND
    repeated = rows.join(F.broadcast(shared) if few else shared, "h")
    first = repeated.groupBy("h", "text", "salts").agg(F.min("doc_id").alias("first"))
    first = first.select("text", F.col("h").alias("first_h"), "first", F.explode(F.expr("sequence(0, salts - 1)")).alias("first_salt")).withColumnRenamed("text", "first_text")
    later = repeated.filter("doc_id > least").withColumn("salt", F.expr("cast(pmod(xxhash64(doc_id), salts) as int)"))
    same = F.expr("h = first_h AND salt = first_salt AND text = first_text AND first < doc_id")
    return later.join(first, same, "left_semi").select("doc_id", "part", "h")


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, h, mask, n) of `docs` (doc_id, text, source): n rows that fail the filters in mask.

    Bit k of mask is the k-th letter of ABCDE. NULL texts are empty texts and a NULL source is the empty
    part. Rows equal in id, part and text are one row with their number; rows without id keep theirs. Very
    long texts are whole texts. Other columns are ignored; an empty table gives no rows.
    """
    rows = _rows(docs)
    bits = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(text_conditions(F.col("text")).values())), F.lit(0))
    own = rows.select("doc_id", "part", "h", bits.alias("bits"), F.lit(1).cast("long").alias("n"))
    copies = later_copies(rows).select("doc_id", "part", "h", F.lit(1 << 4).alias("bits"), F.lit(0).cast("long").alias("n"))
    return own.union(copies).groupBy("doc_id", "part", "h").agg(F.bit_or("bits").alias("mask"), F.sum("n").alias("n"))


def combinations(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows by combination, and those with quality 1 and with toxic 1.

    Documents without a label count as neither; a doc_id labelled several times has a mark that any gives.
    """
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c) for c in ("quality", "toxic")])
    # rows without id have no label; the second key deals them out
    both = failed.withColumn("spread", F.when(F.col("doc_id").isNull(), F.col("h")).otherwise(0)).join(
        marks.withColumn("none", F.lit(0).cast("long")), F.expr("doc_id = labelled AND spread = none"), "left")
    return both.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.coalesce(F.sum(F.col("n") * F.col(c)), F.lit(0)).cast("long").alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))])


def orders_of(found: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """Per part, order of the filters and step: what the filter of that step does to the part's rows.

    `found` is what `combinations` returns. A part has a row for every order and step, zeros included.
    """
    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    steps = found.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.array(*[F.lit(k + 1) for k in range(len(filters))])).alias("step"))
    earlier = sum((F.when(F.expr(f"instr(filter_order, '{x}') < step"), 1 << k).otherwise(0) for k, x in enumerate(filters)), F.lit(0))
    own = sum((F.when(F.expr(f"instr(filter_order, '{x}') = step"), 1 << k).otherwise(0) for k, x in enumerate(filters)), F.lit(0))
    steps = steps.withColumn("own", own).withColumn("before", F.col("mask").bitwiseAND(earlier) != 0)
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    removed = fails & ~F.col("before")

    def total(condition: Column, of: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(of)).otherwise(0)).cast("long")

    # a row that fails k filters is removed by each of them in the k-th part of the orders
    share = F.expr(f"n * ({len(list(permutations(filters)))} div greatest(bit_count(mask), 1))")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~F.col("before")).alias("kept"), total(removed).alias("removed"), total(fails & F.col("before")).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"), total(removed, "good").alias("good_lost"), total(removed, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, share).otherwise(0)).cast("long").alias("shapley"))


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    `docs` has doc_id, text and source, `labels` doc_id, quality and toxic. No documents give no rows.
    """
    return orders_of(combinations(failures(docs), labels))
