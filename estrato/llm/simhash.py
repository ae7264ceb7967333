"""Near-duplicate documents by SimHash: segment popcounts as an embedding, joined on a grid.

A fingerprint's popcounts over sixteen 4-bit segments are a point of a small integer lattice. The
Manhattan distance of two points never exceeds the Hamming distance of the fingerprints, so links
of at most two bits have points within two steps and therefore share a lattice point at most one
step from both. Every distinct fingerprint goes to the grid cells within one step (33 at most);
fingerprints that meet in a cell are compared exactly, and links become components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import record_batch, sliced, stored
from estrato.llm.components import components, forest

SEGMENTS = 16
FEW = 64
"""Cells with more fingerprints are searched by shared one-bit neighbours instead of pair by pair."""

_ONES = np.uint64(0x5555555555555555), np.uint64(0x3333333333333333)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint_of(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half of the shingles' XXH64 values."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        values = np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[: -shingle])).tolist()
        digest = xxhash.xxh64_intdigest
        values = np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts, (ends[shingle - 1 :] - 1).tolist())), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(values), 1 << 16):
        part = values[i : i + (1 << 16)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(values), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])
    for batch in batches:
        values = np.array([fingerprint_of(x) for _, _, texts in sliced(batch.column(1)) for x in texts], np.uint64)
        yield record_batch(schema, batch.column(0), batch.column(2), pa.array(values.view(np.int64)))


def text_hash(column: str = "text") -> Column:
    return F.xxhash64(F.col(column).cast("string"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; NULL and wordless texts have fp 0."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_hash().alias("text_hash")).mapInArrow(_fingerprints, "doc_id long, text_hash long, fp long")


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """The sixteen 4-bit segments' popcounts, packed into the nibbles of one value."""
    pairs = fp - ((fp >> np.uint64(1)) & _ONES[0])
    return (pairs & _ONES[1]) + ((pairs >> np.uint64(2)) & _ONES[1])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("cell", pa.int64()), ("fp", pa.int64())])
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        point = segment_counts(fp)
        cells, owners = [point], [fp]
        for s in range(SEGMENTS):
            step = np.uint64(1 << (4 * s))
            height = (point >> np.uint64(4 * s)) & np.uint64(15)
            for ok, moved in ((height < 4, point + step), (height > 0, point - step)):
                cells.append(moved[ok])
                owners.append(fp[ok])
        yield record_batch(schema, pa.array(np.concatenate(cells).view(np.int64)), pa.array(np.concatenate(owners).view(np.int64)))


def links_in_small_groups(cell: np.ndarray, fp: np.ndarray) -> list[np.ndarray]:
    """Pairs within two bits among rows of equal cell; rows are sorted by cell."""
    found, at = [], np.arange(len(cell) - 1)
    for apart in range(1, FEW):
        at = at[at + apart < len(cell)]
        at = at[cell[at] == cell[at + apart]]
        if not len(at):
            break
        near = np.bitwise_count(fp[at] ^ fp[at + apart]) <= 2
        found.append(np.stack([fp[at[near]], fp[at[near] + apart]], 1))
    return found


def links_in_large_group(fp: np.ndarray, most: int = 1 << 22) -> list[np.ndarray]:
    """Spanning links of a group: values within two bits share a value at most one bit from both.

    The shared values are taken in parts of at most about `most`, so memory doesn't grow with 65 times
    the group. Members of one shared value are pairwise linked; a star keeps them together.
    """
    parts = max(1, 65 * len(fp) // most)
    masks = np.concatenate(([0], np.uint64(1) << np.arange(64, dtype=np.uint64))).astype(np.uint64)
    found = []
    for part in range(parts):
        middles, owners = [], []
        for mask in masks:
            middle = fp ^ mask
            if parts > 1:
                mine = (middle * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts) == part
                middles.append(middle[mine])
                owners.append(fp[mine])
            else:
                middles.append(middle)
                owners.append(fp)
        middle, owner = np.concatenate(middles), np.concatenate(owners)
        order = np.argsort(middle, kind="stable")
        middle, owner = middle[order], owner[order]
        head = np.maximum.accumulate(np.where(np.concatenate(([True], middle[1:] != middle[:-1])), np.arange(len(middle)), 0))
        other = np.flatnonzero(head != np.arange(len(head)))
        found.append(np.stack([owner[head[other]], owner[other]], 1))
    return found


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def out(cell: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(cell):
            return
        bound = np.concatenate(([0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]))
        size = np.diff(bound)
        small = np.repeat(size <= FEW, size)
        found = links_in_small_groups(cell[small], fp[small])
        for g in np.flatnonzero(size > FEW):
            found += links_in_large_group(fp[bound[g] : bound[g + 1]])
        pairs = np.concatenate(found).view(np.int64) if found else np.zeros((0, 2), np.int64)
        if len(pairs):
            yield record_batch(schema, *map(pa.array, forest(pairs)))

    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)))
        rows += batch.num_rows
        if rows < 1 << 19 or held[0][0][0] == held[-1][0][-1]:
            continue
        cell, fp = (np.concatenate(x) for x in zip(*held))
        cut = int(np.searchsorted(cell, cell[-1]))
        yield from out(cell[:cut], fp[:cut])
        held, rows = [(cell[cut:], fp[cut:])], len(cell) - cut
    if held:
        yield from out(*(np.concatenate(x) for x in zip(*held)))


def linked_fingerprints(distinct: DataFrame) -> DataFrame:
    """Spanning links (a, b) among distinct fingerprints that differ in at most two bits."""
    cells = distinct.select("fp").mapInArrow(_cells, "cell long, fp long")
    return cells.repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(_links, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) per row of `docs` (doc_id, text; other columns ignored).

    component_id is the smallest doc_id reachable over links of at most two differing bits, root the smallest
    fingerprint (one per component, also where ids are NULL or stand for several texts). Rows with
    equal text, repeated rows and all texts without words share a fingerprint. A NULL doc_id keeps its
    row; the component of rows that all have NULL ids is NULL. An empty table gives an empty result.
    """
    rows = stored(fingerprints(docs), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    group = components(linked_fingerprints(distinct)).withColumnRenamed("node", "fp")
    rooted = distinct.join(group, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")
