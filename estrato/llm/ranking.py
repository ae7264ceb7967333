"""Ranked lexical search over hashed max-sketches.

An index row holds a document's terms and a sketch: each term's impact, rounded up to a byte, is folded
by maximum into the places that its hashes name. For a batch of items the sketches of many documents
are read at the places of all query terms at once; the least value over a term's places bounds its
impact, and the weighted sum bounds the score. Documents are then scored exactly from their terms in
the order of falling bounds, until no bound reaches the last score that an item's list holds. Each task
keeps one short list per item; the lists are ranked together at the end. Scores are whole numbers.

A batch's terms are counted in the index's term lists first, which gives the items' weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from estrato.llm.common import Words, forget, record_batch, separator_table, sliced, stored

SEPARATORS = separator_table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
TOP = 10
PLACES_PER_TERM = 3
"""A sketch has at least this many places per term, a power of two, and not fewer than LEAST_PLACES."""
LEAST_PLACES = 64
HASHES = 2
ITEM_TERMS = 1 << 17
"""Terms of items that go round in one batch; more items take more passes over the index."""
ROWS = 256
"""Rows of a batch that a task turns into Python objects at a time."""
CELLS = 1 << 18
"""Documents times terms whose bounds a task computes at a time."""
SCALE = 1_000_000_000
MOST_IMPACT = 1 << 20


def impact(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Impact of a term that occurs tf times in a document of n terms: whole numbers, below MOST_IMPACT."""
    m = 100 - 90 + (90 * n * documents) // length
    return (SCALE * tf) // (1000 * tf + 8 * m)


def term_counts(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first of each text, terms, counts, terms of each text with repeats); terms of a text are distinct and rising."""
    words = Words([x.translate(LOWER) for x in texts], SEPARATORS)
    hashes, text = words.hashes(), words.text
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    head = np.flatnonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])))) if len(hashes) else np.zeros(0, np.int64)
    counts = np.diff(np.append(head, len(hashes)))
    return np.searchsorted(text[head], np.arange(len(texts) + 1)), hashes[head], counts, np.diff(words.first)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary())])
    for batch in batches:
        for lo, hi, texts in sliced(batch.column(1), 1 << 18):
            first, terms, counts, n = term_counts(texts)
            bounds = list(zip(first[:-1].tolist(), first[1:].tolist()))
            terms = memoryview(terms.tobytes())
            yield record_batch(schema, batch.column(0).slice(lo, hi - lo), n, [terms[8 * a : 8 * b] for a, b in bounds], [packed(counts[a:b]) for a, b in bounds])


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows: what a task makes of one is small and goes back to the system."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
        pa.default_memory_pool().release_unused()


def packed(counts: np.ndarray) -> bytes:
    """Counts in a byte each where they fit, else in four."""
    return counts.astype("u1" if counts.max(initial=0) < 256 else "<u4").tobytes()


def unpacked(terms: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(terms, counts) of an index row."""
    return np.frombuffer(terms, np.uint64), np.frombuffer(counts, "u1" if 8 * len(counts) == len(terms) else "<u4").astype(np.int64)


def _frequencies(wanted: np.ndarray):
    """(k, df): in how many of the task's documents the k-th of the wanted terms (rising) stands."""
    schema = pa.schema([("k", pa.int64()), ("df", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in in_parts(batches):
            terms = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
            at = np.minimum(np.searchsorted(wanted, terms), len(wanted) - 1)
            total += np.bincount(at[wanted[at] == terms], minlength=len(wanted))
        seen = np.flatnonzero(total)
        yield record_batch(schema, seen, total[seen])

    return run


def places_of(terms: np.ndarray, size: int) -> list[np.ndarray]:
    """The places of each term in a sketch of `size` places, one array per hash."""
    return [((terms >> np.uint64(31 * k)) & np.uint64(size - 1)).astype(np.int64) for k in range(HASHES)]


def folded(impacts: np.ndarray) -> np.ndarray:
    """Impacts as bytes, rounded up: 0 only for none."""
    return (-(-impacts * 255 // MOST_IMPACT)).astype(np.uint8)


def unfolded(values: np.ndarray) -> np.ndarray:
    """The largest impact that folds to each byte."""
    return values.astype(np.int64) * MOST_IMPACT // 255


def sketch_size(terms: int) -> int:
    return max(LEAST_PLACES, 1 << (PLACES_PER_TERM * terms - 1).bit_length())


def _sketched(documents: int, length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary()), ("places", pa.int32()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, ROWS):
            sketches = []
            for n, terms, counts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                terms, tf = unpacked(terms, counts)
                sketch = np.zeros(sketch_size(len(terms)), np.uint8)
                value = folded(impact(tf, np.int64(n), documents, length))
                order = np.argsort(value, kind="stable")  # of values for one place the last written stays: the largest
                for place in places_of(terms[order], len(sketch)):
                    held = np.zeros(len(sketch), np.uint8)
                    held[place] = value[order]
                    np.maximum(sketch, held, out=sketch)
                sketches.append(sketch.tobytes())
            yield record_batch(schema, *batch.columns, [len(x) for x in sketches], sketches)

    return run


class Index:
    """A searchable copy of a document table in the shared folder: term lists and sketches.

    `documents` counts the documents with at least one term, `length` all their terms with repeats.
    """

    def __init__(self, docs: DataFrame):
        """`docs` has doc_id and text; NULL texts and texts without terms are never found. Repeated rows and
        NULL ids are documents of their own. Whole texts count, however long. No documents give an empty index."""
        texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("text IS NOT NULL")
        lists = stored(texts.mapInArrow(_indexed, "doc_id long, n long, terms binary, counts binary").filter("n > 0"), "term-lists")
        self.documents, self.length = lists.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).head()
        sketched = lists.mapInArrow(_sketched(self.documents, self.length), "doc_id long, n long, terms binary, counts binary, places int, sketch binary")
        self.rows = stored(sketched, "sketches")
        forget(lists)

    def batch(self, items: Sequence[tuple[int, Sequence[int]]]) -> Batch | None:
        """Items (number, terms) with their weights; without the terms that no document has, and None if that leaves nothing."""
        wanted = np.unique(np.array([t for _, terms in items for t in terms], np.int64).view(np.uint64))
        df = np.zeros(len(wanted), np.int64)
        if len(wanted):
            counted = self.rows.select("terms").mapInArrow(_frequencies(wanted), "k long, df long").groupBy("k").agg(F.sum("df")).collect()  # a row per term of the batch
            for k, n in counted:
                df[k] = n
        weight = {t: math.floor(1000 * math.log((2 * self.documents + 2) / (2 * n + 1))) for t, n in zip(wanted.view(np.int64).tolist(), df.tolist()) if n}
        known = [(item, [t for t in terms if t in weight]) for item, terms in items]
        known = [(item, terms, [weight[t] for t in terms]) for item, terms in known if terms]
        return Batch(known) if known else None


def numbered(items: DataFrame) -> DataFrame:
    """Stored (item, item_id, terms) of `items` (item_id, text); item numbers the rows, terms are distinct."""
    texts = items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    return stored(texts.mapInArrow(_item_terms, f"item long, item_id {kind}, terms array<long>"), "items")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, texts in sliced(batch.column(2)):
            first, terms, _, _ = term_counts(texts)
            listed = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(terms.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), listed], ["item", "item_id", "terms"])


class Batch:
    """Items that are looked up together: their distinct terms, and each item's places among those and weights."""

    def __init__(self, items: list[tuple[int, list[int], list[int]]]):
        self.item = np.array([i for i, _, _ in items], np.int64)
        of = [np.array(t, np.int64).view(np.uint64) for _, t, _ in items]
        self.terms, at = np.unique(np.concatenate(of), return_inverse=True)
        self.at = at
        self.weight = np.concatenate([np.array(w, np.int64) for _, _, w in items])
        self.size = np.array([len(t) for t in of])
        self.first = np.cumsum(self.size) - self.size
        self.of = np.repeat(np.arange(len(items)), self.size)

    def bounds(self, sketches: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, documents by items; `sketches` has a row per document."""
        places = places_of(self.terms, sketches.shape[1])
        values = sketches[:, places[0]]
        for place in places[1:]:
            np.minimum(values, sketches[:, place], out=values)
        most = unfolded(np.arange(256, dtype=np.uint8))[values]
        return np.add.reduceat(most[:, self.at] * self.weight, self.first, axis=1)

    def impacts(self, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Impact of each of the batch's terms in one document."""
        at = np.minimum(np.searchsorted(terms, self.terms), len(terms) - 1)
        return np.where(terms[at] == self.terms, values[at], 0)

    def score(self, item: int, impacts: np.ndarray) -> int:
        own = slice(self.first[item], self.first[item] + self.size[item])
        return int(self.weight[own] @ impacts[self.at[own]])


class Lists:
    """The best documents found so far, by item: score, then small doc_id first (none last)."""

    def __init__(self, items: int, top: int):
        self.top, self.of = top, [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # scores below this are of no use

    def add(self, item: int, score: int, doc: int | None) -> None:
        own = self.of[item]
        own.append((-score, doc is None, doc or 0))
        if len(own) > self.top:
            own.sort()
            own.pop()
        if len(own) == self.top:
            self.least[item] = -max(own)[0]


def _searched(batch: Batch, documents: int, length: int, top: int):
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Lists(len(batch.item), top)
        for rows in in_parts(batches, ROWS):
            sizes = rows.column(4).to_numpy()
            for size in np.unique(sizes).tolist():
                same = np.flatnonzero(sizes == size)
                step = max(1, CELLS // len(batch.at))
                for lo in range(0, len(same), step):
                    block = same[lo : lo + step]
                    sketches = np.frombuffer(b"".join(rows.column(5).take(pa.array(block)).to_pylist()), np.uint8).reshape(len(block), size)
                    rescored(block, batch.bounds(sketches), rows, best)
        for k, own in enumerate(best.of):
            if own:
                own.sort()
                yield record_batch(schema, [int(batch.item[k])] * len(own), [None if none else doc for _, none, doc in own], [-score for score, _, _ in own])

    def scored(rows: pa.RecordBatch, i: int) -> np.ndarray:
        terms, tf = unpacked(rows.column(2)[i].as_py(), rows.column(3)[i].as_py())
        return batch.impacts(terms, impact(tf, np.int64(rows.column(1)[i].as_py()), documents, length))

    def rescored(block, bounds, rows, best):
        known: dict[int, np.ndarray] = {}
        for item in np.flatnonzero((bounds >= best.least).any(0)).tolist():
            column = bounds[:, item]
            for at in np.argsort(-column, kind="stable").tolist():
                if column[at] < best.least[item]:
                    break
                if at not in known:
                    known[at] = scored(rows, int(block[at]))
                score = batch.score(item, known[at])
                if score >= best.least[item]:
                    best.add(item, score, rows.column(0)[int(block[at])].as_py())

    return run


def batches_of(items: DataFrame, most: int) -> Iterator[list[tuple[int, list[int]]]]:
    """The items in batches of about `most` terms, one batch on the driver at a time."""
    held, size = [], 0
    for item, terms in items.select("item", "terms").toLocalIterator():
        if held and size + len(terms) > most:
            yield held
            held, size = [], 0
        held.append((item, terms))
        size += len(terms)
    if held:
        yield held


def best_documents(index: Index, items: DataFrame, top: int = TOP, batch_terms: int = ITEM_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents with a score above 0 for each row of `items` (item_id, text).

    Equal scores rank by rising doc_id, NULL ids last. NULL texts and items without a known term find
    nothing; repeated items are items of their own. `items` is the stated query set: it goes round in
    batches of `batch_terms` terms, each two passes over the index, of which one reads the term lists only.
    """
    spark = items.sparkSession
    items = numbered(items)
    found = spark.createDataFrame([], "item long, doc_id long, score long")
    for held in batches_of(items, batch_terms):
        batch = index.batch(held)
        if batch is None:
            continue
        run = _searched(batch, index.documents, index.length, top)
        found = found.union(stored(index.rows.mapInArrow(run, "item long, doc_id long, score long"), "found"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
