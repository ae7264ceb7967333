"""Exact repeated passages across documents, found from fixed-block anchors.

Every window of 13 words contains a whole block of 7 words that begins at a multiple of 7 in its
own document. So the blocks, one word in seven, are the index, and all rolling runs of 7 words probe
it. A hit is extended by the windows around it: windows with one content form one class, known by
its 96-bit hash and its smallest doc_id, so a passage in n documents costs n rows and not n*n pairs.
Neighbouring windows of confirmed classes make up the maximal repeats.

Documents are dealt into chunks of a few MB by a hash, so that neither a source nor a group of
copies shapes the work. Between the steps travel sorted, packed hashes, one entry per distinct run
in a chunk; a passage in a third of all documents is one entry per chunk. The exchange that deals
the texts is used by all three steps that read them.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import Words, covered, encoded, task_count, text_bytes, window_hashes

WINDOW = 13
CHUNK_BYTES = 4 << 20
BUCKET_WORDS = 8_000_000
"""Probes per bucket, about: what one task holds when it matches them."""

_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def packed(values: np.ndarray) -> bytes:
    """Bytes in planes, the highest first: planes of zeros shrink when Spark compresses a shuffle."""
    wide = values.dtype.itemsize
    return np.ascontiguousarray(values.astype(values.dtype.newbyteorder(">")).view(np.uint8).reshape(-1, wide).T).tobytes()


def unpacked(data: bytes, kind: str) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(wide, -1).T).view(np.dtype(kind).newbyteorder(">")).reshape(-1).astype(kind)


def gaps(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def ungapped(data: bytes, kind: str) -> np.ndarray:
    return np.cumsum(unpacked(data, kind), dtype=kind)


def found_in(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where each value stands in the sorted array `known`; -1 if it isn't there."""
    if not len(known):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


class Chunk:
    """The words of a chunk's documents, with the anchors' hashes."""

    def __init__(self, docs: pa.Table, window: int, buckets: int):
        self.ids = docs.column("doc_id").combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)
        self.known = docs.column("doc_id").is_valid().combine_chunks().to_numpy(zero_copy_only=False)
        self.texts = encoded(docs.column("text"))
        self.window, self.block = window, (window + 1) // 2
        self.words = Words(self.texts)
        self.hashes = self.words.hashes()
        run = window_hashes(self.hashes, self.block)
        self.anchor = (((run >> _HALF) * np.uint64(buckets)) & ~_LOW) | (run & _LOW)
        """High half: bucket, low half: 32 more bits of the hash."""

    def whole(self, length: int) -> np.ndarray:
        """Whether the run of `length` words at each place lies in one document with a doc_id and a window."""
        n = len(self.words) - length + 1
        if n <= 0:
            return np.zeros(0, bool)
        text = self.words.text
        good = self.known & (np.diff(self.words.first) >= self.window)
        return (text[:n] == text[length - 1 :]) & good[text[:n]]


PROBES = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("runs", pa.binary()), ("block", pa.binary()), ("several", pa.binary())])
HITS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("runs", pa.binary())])
CLASSES = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("head", pa.binary()), ("tail", pa.binary()), ("low", pa.binary()), ("high", pa.binary())])
EARLIER = pa.schema([("chunk", pa.int64()), ("head", pa.binary()), ("low", pa.binary())])
KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.int32())), ("kept", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string", pa.list_(pa.int32()): "array<int>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)


def removed_passages(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) per row of `docs` (doc_id, text; other columns ignored).

    A word goes if a window of `window` consecutive words covers it whose words also start somewhere in
    a document with a smaller doc_id; windows are judged on the input. spans holds first and end word of
    each maximal removed run; kept joins the other words with one space. NULL and empty texts have no
    words and an empty `kept`. A row without doc_id is compared with nothing. Rows that share a doc_id
    don't affect each other. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    _, size = text_bytes(docs)
    chunks = max(task_count(spark), -(-size // chunk_bytes))
    buckets = max(task_count(spark), -(-size // (6 * bucket_words)))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))

    def probe(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        chunk = Chunk(docs, window, buckets)
        at = np.flatnonzero(chunk.whole(chunk.block))
        text = chunk.words.text[at]
        block = (at - chunk.words.first[text]) % chunk.block == 0
        order = np.argsort(chunk.anchor[at], kind="stable")
        anchor, text, block = chunk.anchor[at][order], text[order], block[order]
        if not len(anchor):
            return _rows(PROBES, [])
        head = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        last = np.append(head[1:], len(anchor)) - 1
        several, block, anchor = text[head] != text[last], np.maximum.reduceat(block, head), anchor[head]
        bucket = (anchor >> _HALF).astype(np.int64)
        bound = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        return _rows(PROBES, [
            (int(bucket[a]), key[0].as_py(), gaps((anchor[a:b] & _LOW).astype(np.uint32)), np.packbits(block[a:b]).tobytes(), np.packbits(several[a:b]).tobytes())
            for a, b in zip(bound[:-1], bound[1:])])

    def match(key: tuple[pa.Scalar, ...], probes: pa.Table) -> pa.Table:
        sides = []
        for chunk, runs, block, several in zip(*(probes.column(c).to_pylist() for c in ("chunk", "runs", "block", "several"))):
            run = ungapped(runs, "u4")
            flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(run)).view(bool) for x in (block, several)]
            sides.append((chunk, run, *flags))
        index = np.unique(np.concatenate([run[block] for _, run, block, _ in sides]))
        seen = np.zeros(len(index), np.int64)
        places = []
        for _, run, _, several in sides:
            at = found_in(index, run)
            seen[at[at >= 0]] += 1 + several[at >= 0]
            places.append(at)
        hits = ((chunk, run[(at >= 0) & (seen[at] > 1)]) for (chunk, run, _, _), at in zip(sides, places)) if len(index) else ()
        return _rows(HITS, [(chunk, key[0].as_py(), gaps(run)) for chunk, run in hits if len(run)])

    def extend(key: tuple[pa.Scalar, ...], docs: pa.Table, hits: pa.Table) -> pa.Table:
        if not hits.num_rows or not docs.num_rows:
            return _rows(CLASSES, [])
        chunk = Chunk(docs, window, buckets)
        known = np.sort(np.concatenate([(np.uint64(b) << _HALF) | ungapped(runs, "u4").astype(np.uint64) for b, runs in zip(hits.column("bucket").to_pylist(), hits.column("runs").to_pylist())]))
        hit = (found_in(known, chunk.anchor) >= 0) & chunk.whole(chunk.block)
        sums = np.concatenate(([0], np.cumsum(hit)))
        inside = window - chunk.block + 1
        whole = chunk.whole(window)
        at = np.flatnonzero(whole & (sums[inside : inside + len(whole)] > sums[: len(whole)]))
        if not len(at):
            return _rows(CLASSES, [])
        head = window_hashes(chunk.hashes, window)[at]
        tail = (window_hashes(chunk.words.hashes(1), window, 1)[at] & _LOW).astype(np.uint32)
        ids = chunk.ids[chunk.words.text[at]]
        order = np.lexsort((ids, tail, head))
        head, tail, ids = head[order], tail[order], ids[order]
        first = np.flatnonzero(np.concatenate(([True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1]))))
        last = np.append(first[1:], len(head)) - 1
        head, tail, low, high = head[first], tail[first], ids[first], ids[last]
        bucket = ((head >> _HALF) * np.uint64(buckets) >> _HALF).astype(np.int64)
        bound = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        return _rows(CLASSES, [
            (int(bucket[a]), key[0].as_py(), gaps(head[a:b]), packed(tail[a:b]), packed(low[a:b]), packed(high[a:b] - low[a:b])) for a, b in zip(bound[:-1], bound[1:])])

    def settle(key: tuple[pa.Scalar, ...], classes: pa.Table) -> pa.Table:
        rows = [(c, ungapped(h, "u8"), unpacked(t, "u4"), unpacked(x, "i8"), unpacked(y, "i8")) for c, h, t, x, y in zip(*(classes.column(n).to_pylist() for n in ("chunk", "head", "tail", "low", "high")))]
        sizes = [len(r[1]) for r in rows]
        head, tail, low, more = (np.concatenate([r[i] for r in rows]) for i in range(1, 5))
        order = np.lexsort((low, tail, head))
        first = np.concatenate(([True], (head[order][1:] != head[order][:-1]) | (tail[order][1:] != tail[order][:-1])))
        least = np.empty(len(head), np.int64)
        least[order] = low[order][np.flatnonzero(first)[np.cumsum(first) - 1]]
        later = least < low + more
        out, a = [], 0
        for (chunk, *_), n in zip(rows, sizes):
            mine = later[a : a + n]
            if mine.any():
                out.append((chunk, gaps(head[a : a + n][mine]), packed(least[a : a + n][mine])))
            a += n
        return _rows(EARLIER, out)

    def remove(key: tuple[pa.Scalar, ...], docs: pa.Table, earlier: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _rows(KEPT, [])
        chunk = Chunk(docs, window, buckets)
        words, gone = chunk.words, np.zeros(len(chunk.words), bool)
        if earlier.num_rows:
            head = np.concatenate([ungapped(x, "u8") for x in earlier.column("head").to_pylist()])
            least = np.concatenate([unpacked(x, "i8") for x in earlier.column("low").to_pylist()])
            order = np.argsort(head, kind="stable")
            head, least = head[order], least[order]
            whole = chunk.whole(window)
            at = found_in(head, window_hashes(chunk.hashes, window))
            start = np.flatnonzero((at >= 0) & whole & (least[at] < chunk.ids[words.text[: len(whole)]]))
            gone = covered(len(words), start, window)
        lost = np.concatenate(([0], np.cumsum(gone)))[words.first]
        kept, spans = [], []
        for k, text in enumerate(chunk.texts):
            mine = gone[words.first[k] : words.first[k + 1]]
            if lost[k + 1] == lost[k]:
                kept.append(b" ".join(text.split()))
                spans.append([])
            else:
                kept.append(b" ".join(compress(text.split(), ~mine)))
                spans.append(np.flatnonzero(np.diff(np.concatenate(([0], mine.view(np.int8), [0])))).astype(np.int32))
        return pa.table([docs.column("doc_id"), pa.array(np.diff(words.first)), pa.array(np.diff(lost)), pa.array(spans, KEPT.field("spans").type), pa.array(kept, pa.binary()).cast(pa.string())], schema=KEPT)

    probes = dealt.groupBy("chunk").applyInArrow(probe, _ddl(PROBES))
    hits = probes.groupBy("bucket").applyInArrow(match, _ddl(HITS))
    classes = dealt.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(extend, _ddl(CLASSES))
    earlier = classes.groupBy("bucket").applyInArrow(settle, _ddl(EARLIER))
    return dealt.groupBy("chunk").cogroup(earlier.groupBy("chunk")).applyInArrow(remove, _ddl(KEPT))
