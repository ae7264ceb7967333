"""Near copies: texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more, on request those that SimHash groups too.

The pipeline asks for both: all links of SimHash (fingerprints within two bits, `simhash.py`) then hold as they are,
whatever the similarity; otherwise each text of a SimHash group is verified against its head. Those whose
fingerprints differ in more bits are texts that share a band of a MinHash sketch (40 bands of 5 minima: a pair at 0.8 is
missed once in some seven million). Every candidate pair is verified on its whole shingle sets, so no link
is an estimate. Texts of equal sets are one node throughout. In a band of more than a few nodes all are
first verified against some pivots, other ones in each band. Only nodes of bands that are then still in
different components go on, and not pair by pair: they meet again where they share one of their rarest
shingles, with exact bounds on lengths and places, so a crowd of texts that resemble each other without
being copies needs no quadratic number of comparisons.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import Words, mixed, record_batch, sliced, stored, window_hashes
from estrato.llm.components import components
from estrato.llm.simhash import near_duplicates, text_hash

SHINGLE = 5
BANDS, MINIMA = 40, 5
FEW = 8
"""Nodes of larger bands are not compared pair by pair."""
PIVOTS = 3
"""Nodes of a larger band that all its others are verified against."""
SIMILARITY = 4, 5
"""Least similarity, as a fraction of whole numbers."""

_STEPS = mixed(np.arange(1, BANDS * MINIMA + 1, dtype=np.uint64)) | np.uint64(1)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_sets(texts: Sequence[bytes]) -> list[np.ndarray]:
    """Distinct hashes of each text's runs of five words; fewer words are one run, no words give none."""
    words = Words([x.translate(_LOWER) for x in texts])
    hashes = words.hashes()
    grams = window_hashes(hashes, SHINGLE)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        own = grams[a : b - SHINGLE + 1] if b - a >= SHINGLE else window_hashes(hashes[a:b], b - a) if b > a else hashes[:0]
        out.append(np.unique(own))
    return out


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(node, band keys) per set that is not empty; equal sets have equal nodes."""
    sizes = np.array([len(x) for x in sets], np.int64)
    values, at = np.concatenate(sets), np.cumsum(sizes) - sizes
    nodes = mixed(np.add.reduceat(mixed(values ^ _STEPS[0]), at) + sizes.astype(np.uint64))
    keys = np.empty((len(sets), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(sets), band + 1, np.uint64)
        for step in _STEPS[band * MINIMA : (band + 1) * MINIMA]:
            key = mixed(key * _STEPS[1] ^ np.minimum.reduceat(values * step, at))
        keys[:, band] = key
    return nodes, keys


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("keys", pa.list_(pa.int64()))])
    for batch in batches:
        for lo, hi, texts in sliced(batch.column(1)):
            sets = shingle_sets(texts)
            sizes = np.array([len(x) for x in sets], np.int32)
            some = np.flatnonzero(sizes)
            node, keys = np.zeros(hi - lo, np.uint64), np.zeros((0, BANDS), np.uint64)
            if len(some):
                node[some], keys = sketches([sets[i] for i in some])
            offsets = np.concatenate(([0], np.cumsum(np.where(sizes > 0, BANDS, 0)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1).view(np.int64)))
            yield record_batch(schema, batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(node.view(np.int64)), pa.array(sizes), lists)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.int64()), ("grams", pa.list_(pa.int64()))])
    for batch in batches:
        for lo, hi, texts in sliced(batch.column(1)):
            sets = shingle_sets(texts)
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
            yield record_batch(schema, batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64))))


def _sizes_allow(x: str, y: str) -> str:
    p, q = SIMILARITY
    return f"{q} * least({x}, {y}) >= {p} * greatest({x}, {y})"


def _band_pairs(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) to verify first: all of a small band, some stars of a larger one."""
    few = shared.filter(f"size <= {FEW}")
    meet = "x.band = y.band AND x.node < y.node AND " + _sizes_allow("x.n", "y.n")
    pairs = few.alias("x").join(few.alias("y"), F.expr(meet)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    stars = shared.filter(f"size > {FEW}").select("node", "n", F.explode("pivots").alias("p"))
    stars = stars.filter("p.node <> node AND " + _sizes_allow("n", "p.n"))
    return pairs.union(stars.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")))


def _fingerprint_links(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Links (a, b, near) of each node with the head of every SimHash group that a text of it is in, so a group needs
    links in proportion; near: their sizes allow the similarity."""
    alike = near_duplicates(docs).select("text_hash", "root").distinct()
    held = stored(rows.select("node", "n", "text_hash").distinct().join(alike, "text_hash").select("root", "node", "n").distinct(), "alike")
    heads = held.groupBy("root").agg(F.min(F.struct("node", "n")).alias("p"), F.count(F.lit(1)).alias("size")).filter("size > 1").drop("size")
    return held.join(heads, "root").filter("node <> p.node").select(F.col("p.node").alias("a"), F.col("node").alias("b"), F.expr(_sizes_allow("n", "p.n")).alias("near"))


def _prefix_pairs(crowd: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of `crowd` (node, label) in different components that can reach the similarity.

    Shingles are ordered by rarity in the crowd. If sets of n >= m shingles overlap in at least
    o = (n + m) * p / (p + q), their first common shingle stands no later than n - o + 1 and m - o + 1; so the
    smaller set is filed under its rarest m - ceil(2 m p / (p + q)) + 1, the larger one looks up its
    rarest n - ceil(n p / q) + 1, and both places bound the overlap. Shingles of one node alone come
    first and are only counted.
    """
    p, q = SIMILARITY
    own = sets.join(crowd, "node").select("node", "label", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    known = own.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    listed = own.join(known, "gram").groupBy("node", "label", "n").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("common"))
    first = listed.withColumn("alone", F.expr("n - size(common)")).withColumn("most", F.expr(f"n - (n * {p} + {q} - 1) div {q} + 1 - alone"))
    first = stored(first.filter("most > 0").select("node", "label", "n", F.expr(f"n - (2 * n * {p} + {p + q} - 1) div {p + q} + 1").alias("filed"),
                   F.posexplode(F.expr("transform(slice(common, 1, most), x -> x.gram)")).alias("at", "gram"), "alone"), "prefixes")
    first = first.withColumn("place", F.expr("alone + at + 1"))
    small, large = first.filter("place <= filed").alias("x"), first.alias("y")
    reach = f"{p + q} * (1 + least(x.n - x.place, y.n - y.place)) >= {p} * (x.n + y.n)"
    meet = "x.gram = y.gram AND x.label <> y.label AND (x.n < y.n OR x.n = y.n AND x.node < y.node) AND " + _sizes_allow("x.n", "y.n") + " AND " + reach
    return small.join(large, F.expr(meet)).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    p, q = SIMILARITY
    both = pairs.join(sets.toDF("a", "one"), "a").join(sets.toDF("b", "two"), "b")
    common = both.select("a", "b", (F.size("one") + F.size("two")).alias("total"), F.size(F.array_intersect("one", "two")).alias("same"))
    return common.filter(F.expr(f"{q} * same >= {p} * (total - same)")).select("a", "b")


def near_copies(docs: DataFrame, on_pairs: Callable[[DataFrame], None] = lambda pairs: None, fingerprints: bool = False) -> DataFrame:
    """(doc_id, text_hash, root) per row of `docs` (doc_id, text; other columns ignored).

    Rows have the same root where links of at least SIMILARITY connect them, with `fingerprints` also where
    links of SimHash do. All rows without words, NULL texts too, have one root, as have repeated rows. A NULL
    doc_id keeps its row. A very long text is one set of shingles. An empty table gives an empty result.
    `on_pairs` is shown the tables of pairs to verify.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_hash().alias("text_hash"))
    rows = stored(texts.mapInArrow(_sketched, "doc_id long, text_hash long, node long, n int, keys array<long>"), "sketches")
    nodes = rows.filter("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("keys").alias("keys"), F.min("text_hash").alias("text_hash"))
    bands = stored(nodes.select("node", "n", "text_hash", F.explode("keys").alias("band")), "bands")
    pivot = [F.struct(F.min_by("node", F.struct(by, "node")).alias("node"), F.min_by("n", F.struct(by, "node")).alias("n")) for by in (F.xxhash64("node", "band", F.lit(k)) for k in range(PIVOTS))]
    crowds = bands.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.array(*pivot).alias("pivots")).filter("size > 1")
    crowds = crowds.withColumn("pivots", F.expr(f"CASE WHEN size > {FEW} THEN pivots END"))
    shared = stored(bands.join(crowds, "band"), "bands")
    alike, pairs = _fingerprint_links(docs, rows), _band_pairs(shared)
    pairs = stored((pairs if fingerprints else pairs.union(alike.filter("near").select("a", "b"))).distinct(), "pairs")
    on_pairs(pairs)
    large = shared.filter(f"size > {FEW}").select("band", "node")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(large.select("node")).distinct()
    wanted = nodes.select("node", "text_hash").join(wanted, "node", "left_semi")
    sets = texts.join(wanted, "text_hash").groupBy("node").agg(F.first("text").alias("text"))
    sets = stored(sets.mapInArrow(_sets, "node long, grams array<long>"), "sets")
    links = _verified(pairs, sets)
    links = stored(links.union(alike.select("a", "b")) if fingerprints else links, "links")
    group = components(links)
    if not large.isEmpty():
        labelled = large.join(group, "node", "left").select("band", "node", F.coalesce("component", "node").alias("label"))
        apart = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("band")
        crowd = stored(labelled.join(apart, "band", "left_semi").select("node", "label").distinct(), "crowd")
        if not crowd.isEmpty():
            pairs = stored(_prefix_pairs(crowd, sets), "pairs")
            on_pairs(pairs)
            group = components(links.union(_verified(pairs, sets)))
    return rows.select("doc_id", "text_hash", "node").join(group, "node", "left").select("doc_id", "text_hash", F.coalesce("component", "node").alias("root"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay when one document of each group of near copies, by SimHash or by similarity, is kept.

    The smallest doc_id of a group stays, rows without doc_id last; of different texts under one id, or
    without one, the smallest hash. Of rows equal in id and text the smallest in all other columns stays.
    """
    rows = near_copies(docs, fingerprints=True).groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    head = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash", "n")).alias("head")
    heads = rows.groupBy("root").agg(head).select("head.doc_id", "head.text_hash", "head.n")
    heads = stored(heads, "heads").select(F.col("doc_id").alias("head_id"), F.col("text_hash").alias("head_hash"), F.col("n").alias("head_n"))
    kept = docs.join(heads, docs["doc_id"].eqNullSafe(heads["head_id"]) & (text_hash() == heads["head_hash"]), "left_semi")
    if heads.filter("head_n > 1").isEmpty():
        return kept
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    if not others:
        return kept.distinct()
    return kept.groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("least")).select("doc_id", "text", "least.*").select(*docs.columns)
