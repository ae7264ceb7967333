"""Benchmark passages in documents: prefix-filtered containment join over item-sized windows.

A benchmark window is a set of word positions that must occur in a document as a whole, so its
prefix is one token: by the usual prefix-filter rule, a set that must be contained entirely shares
its rarest token. Tokens are ordered by their count over all documents. Document words join the
prefix tokens; the token's place in the window fixes where the window would start (positional
bound) and the window must fit into the document (length bound); what passes is verified by the
window's 128-bit hash over all its words. Windows come from item texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import Words, record_batch, separator_table, sliced, stored, window_hashes

SEPARATORS = separator_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
"""All bytes but digits, a-z and those of non-ASCII characters separate words."""
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

BLOCK_BYTES = 4 << 20
"""Item text per block. Larger benchmarks are taken in several passes over the documents."""


def lower_words(texts: list[bytes]) -> Words:
    return Words([x.translate(_LOWER) for x in texts], SEPARATORS)


@dataclass
class Windows:
    """Distinct windows of one block of items, grouped by length, with the items that hold them."""

    length: np.ndarray
    identity: np.ndarray  # (n, 2) values of 64 bits
    tokens: list[np.ndarray]  # word hashes per window
    items: list[list[int]]


def windows_of(items: list[tuple[int | None, bytes]], size: int) -> Windows:
    words = lower_words([x for _, x in items])
    first, second = words.hashes(0), words.hashes(1)
    found: dict[tuple[int, int, int], tuple[np.ndarray, set]] = {}
    for k, (item, _) in enumerate(items):
        lo, hi = words.first[k], words.first[k + 1]
        length = int(min(size, hi - lo))
        if not length:
            continue
        for at, (x, y) in enumerate(zip(window_hashes(first[lo:hi], length, 0).tolist(), window_hashes(second[lo:hi], length, 1).tolist())):
            entry = found.setdefault((length, x, y), (first[lo + at : lo + at + length], set()))
            if item is not None:
                entry[1].add(item)
    keys = sorted(found)
    return Windows(
        np.array([k[0] for k in keys], np.int64), np.array([k[1:] for k in keys], np.uint64).reshape(-1, 2),
        [found[k][0] for k in keys], [sorted(found[k][1]) for k in keys],
    )


def token_counts(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Occurrences over all documents of each word in `vocabulary` (sorted hashes, bounded by a block)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for _, _, texts in sliced(batch.column(0)):
                hashes = lower_words(texts).hashes(0)
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                total += np.bincount(at[known[at] == hashes], minlength=len(known))
        seen = np.flatnonzero(total)
        yield record_batch(pa.schema([("k", pa.int64()), ("n", pa.int64())]), seen, total[seen])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(vocabulary), np.int64)
    for k, n in rows:
        out[k] = n
    return out


@dataclass
class Index:
    """Windows sorted by prefix token."""

    token: np.ndarray  # distinct prefix tokens, sorted
    bound: np.ndarray  # windows bound[t]:bound[t+1] have token t
    place: np.ndarray  # of the token in the window
    length: np.ndarray
    identity: np.ndarray
    items: list[list[int]]


def index_of(windows: Windows, vocabulary: np.ndarray, counts: np.ndarray) -> Index:
    """Orders each window's tokens by rarity (ties by hash) and files the window under the rarest."""
    place = np.zeros(len(windows.length), np.int64)
    prefix = np.zeros(len(windows.length), np.uint64)
    for i, tokens in enumerate(windows.tokens):
        place[i] = np.lexsort((tokens, counts[np.searchsorted(vocabulary, tokens)]))[0]
        prefix[i] = tokens[place[i]]
    order = np.argsort(prefix, kind="stable")
    token, bound = np.unique(prefix[order], return_index=True)
    return Index(token, np.append(bound, len(order)), place[order], windows.length[order], windows.identity[order], [windows.items[i] for i in order])


def occurrences(words: Words, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every verified occurrence in the texts of `words`."""
    if not len(index.token) or not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = words.hashes(0)
    at = np.minimum(np.searchsorted(index.token, first), len(index.token) - 1)
    hit = np.flatnonzero(index.token[at] == first)
    starts, windows = [], []
    second = None
    for lo in range(0, len(hit), 1 << 17):  # candidates of a bounded number of words at a time
        part = hit[lo : lo + (1 << 17)]
        token = at[part]
        n = index.bound[token + 1] - index.bound[token]
        window = np.repeat(index.bound[token] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        start = np.repeat(part, n) - index.place[window]
        end = start + index.length[window]
        owner = words.text[np.repeat(part, n)]
        fits = (start >= words.first[owner]) & (end <= words.first[owner + 1])
        start, window = start[fits], window[fits]
        for length in np.unique(index.length[window]):
            mine = index.length[window] == length
            s, w = start[mine], window[mine]
            if second is None and len(s):
                second = words.hashes(1)
            spans = s[:, None] + np.arange(length)
            same = (_hash_rows(first[spans], 0) == index.identity[w, 0]) & (_hash_rows(second[spans], 1) == index.identity[w, 1])
            starts.append(s[same])
            windows.append(w[same])
    return (np.concatenate(starts), np.concatenate(windows)) if starts else (np.zeros(0, np.int64),) * 2


def _hash_rows(rows: np.ndarray, which: int) -> np.ndarray:
    """`window_hashes` of each row of an array as wide as the window."""
    n, length = rows.shape
    if not n:
        return np.zeros(0, np.uint64)
    return window_hashes(np.ascontiguousarray(rows).reshape(-1), length, which)[:: length]


HITS = pa.schema([("__hits", pa.list_(pa.int32())), ("__items", pa.list_(pa.int64())), ("__n_words", pa.int64())])


def blocks_of(items: DataFrame, most: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """Items in blocks of about `most` bytes; whole items only. Streams partition by partition."""
    held, size = [], 0
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text is not null").orderBy("item_id", "text").toLocalIterator():
        text = row[1].encode()
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append((row[0], text))
        size += len(text)
    yield held


def passages(docs: DataFrame, block: list[tuple[int | None, bytes]], size: int = 10, counted: DataFrame | None = None) -> DataFrame:
    """docs' columns (text among them) and __hits (word numbers), __items, __n_words: findings of one block of items.

    Words are counted over `counted` (text) if given: which word of a window is rarest decides where it is filed, not what is found.
    """
    spark = docs.sparkSession
    windows = windows_of(block, size)
    vocabulary = np.unique(np.concatenate(windows.tokens)) if windows.tokens else np.zeros(0, np.uint64)
    counts = token_counts(docs if counted is None else counted, vocabulary) if len(vocabulary) else np.zeros(0, np.int64)
    index = spark.sparkContext.broadcast(index_of(windows, vocabulary, counts))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in sliced(batch.column("text")):
                words = lower_words(texts)
                starts, found = occurrences(words, index.value)
                lengths = index.value.length[found]
                step = np.zeros(len(words) + 1, np.int32)
                np.add.at(step, starts, 1)
                np.add.at(step, starts + lengths, -1)
                hit = np.cumsum(step[:-1]) > 0
                owners: dict[int, set[int]] = {}
                for doc, window in set(zip(words.text[starts].tolist(), found.tolist())):
                    owners.setdefault(doc, set()).update(index.value.items[window])
                places = [np.flatnonzero(hit[words.first[k] : words.first[k + 1]]).astype(np.int32) for k in range(hi - lo)]
                part = batch.slice(lo, hi - lo)
                more = [pa.array(places, HITS.field(0).type), pa.array([sorted(owners.get(k, ())) for k in range(hi - lo)], HITS.field(1).type), pa.array(np.diff(words.first), pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, *HITS.names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(find, f"{fields}, __hits array<int>, __items array<long>, __n_words long")


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, hits, items) per row of `docs` (doc_id, text; other columns ignored).

    hits are the numbers of the words inside an occurrence of a window: `size` consecutive item words,
    or all words of a shorter item; items are the distinct item_ids with such a window. NULL and empty
    texts have no words. A NULL item_id marks words but is not listed; repeated items count once. One
    block of items needs no shuffle; with more blocks the findings per document are merged by a row
    number given before the first pass. An empty benchmark, or one without words, finds nothing.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    findings = [F.col("__n_words").alias("n_words"), F.col("__hits").alias("hits"), F.col("__items").alias("items")]
    total = items.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).head()[0]
    if total <= block_bytes:
        (block,) = blocks_of(items, block_bytes)
        return passages(narrow, block, size).select("doc_id", *findings)
    numbered = stored(narrow.withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = None
    for block in blocks_of(items, block_bytes):
        part = passages(numbered, block, size).select("row", "doc_id", *findings)
        found = part if found is None else found.union(part)
    return (
        found.groupBy("row", "doc_id", "n_words")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        .drop("row")
    )


def clean_documents(docs: DataFrame, items: DataFrame, size: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` (text and any other columns) without the rows in which a benchmark window occurs; block after block, no shuffle.

    Every block counts its words over all of `docs`, so the passes grow with the number of blocks. NULL and empty
    texts stay, as do repeated rows that are clean; an empty benchmark removes nothing, and very long texts are searched whole.
    """
    names, given = docs.columns, docs
    for block in blocks_of(items, block_bytes):
        docs = passages(docs, block, size, given).filter(F.size("__hits") == 0).select(*names)
    return docs
