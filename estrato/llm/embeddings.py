"""Near-duplicate vectors of equal label by a forest of random-projection trees.

Equal vectors are one class first. Per label, each tree splits recursively along a random direction
near the median of a bounded sample; rows in the overlap around the split go to both sides (spill).
Every class is routed to the leaves of all trees, classes that share a leaf are compared exactly in
double precision, and verified links are united. A leaf that stays large is split again with a
fresh sample, and what cannot be split is compared in pairs of blocks, so no task holds an unbounded
group and no leaf is cut. A link is counted in the first leaf that its two classes share, which needs
each class's own leaves only: links are neither shuffled nor deduplicated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import record_batch, stored
from estrato.llm.components import components, forest

TREES = 8
LEAF = 512
"""Classes per leaf aimed at."""
SPILL = 0.08
"""Share of a node's sample on either side of the median that goes to both children."""
SAMPLE = 8192
"""Rows per group that splits are fitted on, about."""
DEPTH = 8
ROUNDS = 5
DENSE = 0.02
"""A node where this share of pairs links is not split: splits would part many links, and comparing
all its pairs costs at most 1/DENSE comparisons per link."""
BLOCK = 2048
"""Rows per block in the comparison of a leaf that stays large."""
ROUTE = 50_000
"""Rows of one group that are routed in one task."""


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(2)
        data, ok = [], []
        for i, values in enumerate(column):
            x = values.values
            vector = None if x is None or x.null_count else x.to_numpy().astype("<f8")
            good = vector is not None and len(vector) > 0 and bool(np.isfinite(vector).all()) and bool(vector.any())
            data.append(vector.tobytes() if good else None)
            ok.append(good)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], ["vec_id", "label", "v"])


def unit(data: list[bytes]) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that squares neither vanish nor overflow."""
    x = np.frombuffer(b"".join(data), "<f8").reshape(len(data), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def direction(tree: int, node: int, size: int) -> np.ndarray:
    return np.random.default_rng([tree, node, size]).standard_normal(size)


def dense(x: np.ndarray, threshold: float, most: int = 256) -> bool:
    part = x[np.random.default_rng(len(x)).choice(len(x), min(most, len(x)), replace=False)]
    return (part @ part.T >= threshold).sum() - len(part) > DENSE * len(part) * (len(part) - 1)


def fit_tree(x: np.ndarray, tree: int, total: int, threshold: float, leaf: int = LEAF, spill: float = SPILL, depth: int = DEPTH) -> dict[int, tuple[float, float]]:
    """Heap number of each inner node -> (right child begins at, left child ends at)."""
    splits: dict[int, tuple[float, float]] = {}
    open_nodes = [(1, np.arange(len(x)), 0)]
    while open_nodes:
        node, rows, level = open_nodes.pop()
        if level == depth or len(rows) * total <= leaf * len(x) or len(rows) < 16 or dense(x[rows], threshold):
            continue
        along = x[rows] @ direction(tree, node, x.shape[1])
        low, high = np.quantile(along, [0.5 - spill, 0.5 + spill])
        left, right = rows[along <= high], rows[along >= low]
        if max(len(left), len(right)) > 0.9 * len(rows):
            continue
        splits[node] = (float(low), float(high))
        open_nodes += [(2 * node, left, level + 1), (2 * node + 1, right, level + 1)]
    return splits


def route(x: np.ndarray, tree: int, splits: dict[int, tuple[float, float]]) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows) for all leaves of the tree that get rows."""
    open_nodes = [(1, np.arange(len(x)))]
    while open_nodes:
        node, rows = open_nodes.pop()
        if not len(rows):
            continue
        if node not in splits:
            yield node, rows
            continue
        low, high = splits[node]
        along = x[rows] @ direction(tree, node, x.shape[1])
        open_nodes += [(2 * node, rows[along <= high]), (2 * node + 1, rows[along >= low])]


def leaf_name(group: int, tree: int, node: int) -> int:
    return xxhash.xxh64_intdigest(f"{group}/{tree}/{node}") - (1 << 63)


def compare(x: np.ndarray, weight: np.ndarray, side: np.ndarray, leaves: list[list[int]], leaf: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(weight of new partners per row, linked pairs) within a leaf; side 0/1 compare across, 2 within.

    Pairs that share an earlier leaf are counted there and left out here.
    """
    across = bool((side == 0).any()) and bool((side == 1).any())
    rows = np.flatnonzero(side == 0) if across else np.arange(len(x))
    cols = np.flatnonzero(side == 1) if across else rows
    earlier = [[y for y in own if y < leaf] for own in leaves]
    flat = np.array([y for own in earlier for y in own], np.int64)
    owner = np.repeat(np.arange(len(x)), [len(own) for own in earlier])
    names, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    keep = n[at] > 1
    _, at = np.unique(at[keep], return_inverse=True)
    shares = np.zeros((len(x), int(at.max()) + 1 if len(at) else 0), np.float32)
    shares[owner[keep], at] = 1
    new = np.zeros(len(x), np.int64)
    pairs = []
    for a in range(0, len(rows), 512):
        part = rows[a : a + 512]
        linked = x[part] @ x[cols].T >= threshold
        if not across:
            linked &= part[:, None] < cols[None, :]
        if shares.shape[1]:
            linked &= shares[part] @ shares[cols].T == 0
        i, j = np.nonzero(linked)
        np.add.at(new, part[i], weight[cols[j]])
        np.add.at(new, cols[j], weight[part[i]])
        pairs.append(np.stack([part[i], cols[j]], 1))
    return new, np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)


def leaves_of(classes: DataFrame, threshold: float, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, rounds: int = ROUNDS, route_rows: int = ROUTE) -> DataFrame:
    """(cid, leaf): every class with all its leaves. `classes` has cid, grp, v."""
    MODEL = pa.schema([("grp", pa.int64()), ("tree", pa.list_(pa.int32())), ("node", pa.list_(pa.int64())), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("parts", pa.int64())])

    def fitted(trees: int):
        def fit(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
            x, total = unit(rows.column("v").to_pylist()), rows.column("n_grp")[0].as_py()
            splits = [(t, node, *ends) for t in range(trees) for node, ends in fit_tree(x, t, total, threshold, leaf).items()]
            columns = [[s[i] for s in splits] for i in range(4)]
            return pa.table([[key[0].as_py()], *([c] for c in columns), [-(-total // route_rows)]], schema=MODEL)

        return fit

    def sent(trees: int):
        def send(key: tuple[pa.Scalar, ...], rows: pa.Table, model: pa.Table) -> pa.Table:
            schema = pa.schema([("cid", pa.int64()), ("grp", pa.int64())])
            if not rows.num_rows:
                return schema.empty_table()
            x, cid = unit(rows.column("v").to_pylist()), rows.column("cid").to_numpy()
            splits: list[dict[int, tuple[float, float]]] = [{} for _ in range(trees)]
            for t, node, low, high in zip(*(model.column(c).to_pylist()[0] for c in ("tree", "node", "low", "high"))) if model.num_rows else ():
                splits[t][node] = (low, high)
            cids, names = [], []
            for t in range(trees):
                for node, mine in route(x, t, splits[t]):
                    cids.append(cid[mine])
                    names.append(np.full(len(mine), leaf_name(key[0].as_py(), t, node)))
            return pa.table([np.concatenate(cids), np.concatenate(names)], schema=schema)

        return send

    current, settled = classes.select("cid", "grp"), []
    for turn in range(rounds):
        own = trees if turn == 0 else 1
        large = stored(current.groupBy("grp").agg(F.count("*").alias("n_grp")).filter(F.col("n_grp") > leaf), "groups")
        if large.isEmpty():
            settled.append(current)
            break
        rows = current.join(large, "grp").join(classes.select("cid", "v"), "cid")
        chosen = F.pmod(F.xxhash64("cid", F.lit(turn)), F.lit(1 << 40)) < F.lit(sample) / F.col("n_grp") * (1 << 40)
        model = stored(rows.filter(chosen).groupBy("grp").applyInArrow(fitted(own), "grp long, tree array<int>, node array<long>, low array<double>, high array<double>, parts long"), "trees")
        model = model.filter(F.size("node") > 0)
        settled.append(current.join(model, "grp", "left_anti").select("cid", "grp"))
        dealt = rows.join(model.select("grp"), "grp", "left_semi").withColumn("part", F.pmod(F.xxhash64("cid"), F.ceil(F.col("n_grp") / route_rows)))
        copies = model.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        current = stored(dealt.groupBy("grp", "part").cogroup(copies.groupBy("grp", "part")).applyInArrow(sent(own), "cid long, grp long"), "leaves")
    else:
        settled.append(current)
    out = settled[0]
    for more in settled[1:]:
        out = out.union(more)
    return out.select("cid", F.col("grp").alias("leaf"))


def compared(classes: DataFrame, leaves: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(a, b, n): n new partners of class a where b is NULL, else a spanning link of a and b."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def one(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        if rows.num_rows < 2:
            return schema.empty_table()
        cid = rows.column("cid").to_numpy()
        new, pairs = compare(unit(rows.column("v").to_pylist()), rows.column("n").to_numpy(), rows.column("side").to_numpy(), rows.column("leaves").to_pylist(), key[0].as_py(), threshold)
        a, b = forest(cid[pairs]) if len(pairs) else (np.zeros(0, np.int64),) * 2
        got = np.flatnonzero(new)
        return pa.table([
            pa.array(np.concatenate([cid[got], a])), pa.array([None] * len(got) + b.tolist(), pa.int64()), pa.array(new[got].tolist() + [None] * len(a), pa.int64())], schema=schema)

    blocks = leaves.groupBy("leaf").agg(F.ceil(F.count("*") / block).alias("blocks"))
    listed = leaves.join(blocks, "leaf").groupBy("cid").agg(F.collect_list(F.struct("leaf", "blocks")).alias("own"))
    own = F.pmod(F.xxhash64("cid", F.lit("block")), F.col("blocks"))
    rows = (
        classes.select("cid", "v", "n").join(listed, "cid")
        .select("cid", "v", "n", F.transform("own", lambda x: x["leaf"]).alias("leaves"), F.explode("own").alias("o"))
        .select("cid", "v", "n", "leaves", F.col("o.leaf").alias("leaf"), F.col("o.blocks").alias("blocks"))
        .withColumn("mine", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("cid", "v", "n", "leaves", "leaf", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"))
    )
    return rows.groupBy("leaf", "i", "j").applyInArrow(one, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, trees: int = TREES, leaf: int = LEAF, block: int = BLOCK, route_rows: int = ROUTE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of `vectors` (vec_id, embedding, label; others ignored).

    Two rows link if their labels are equal and their cosine in double precision is at least `threshold`;
    no link below it is returned, and links in no common leaf are missed (recall is measured in the tests).
    Vectors that are NULL, empty, zero, or hold NULL or non-finite components, and rows without label link
    with nothing; so do vectors of different lengths. component_id is the smallest vec_id reachable,
    kept marks the row whose own id that is; a row without vec_id takes part, and is kept if no row of
    its component has an id. Repeated rows are rows of their own. An empty table gives an empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding").mapInArrow(_vectors, "vec_id long, label string, v binary")
    rows = stored(rows.withColumn("digest", F.md5("v")), "vectors")
    usable = rows.filter("label is not null and v is not null")
    classes = usable.groupBy("label", "digest").agg(F.first("v").alias("v"), F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()).withColumn("grp", F.xxhash64("label", F.octet_length("v"))), "classes")
    leaves = stored(leaves_of(classes, threshold, trees, leaf, route_rows=route_rows), "leaves")
    found = stored(compared(classes, leaves, threshold, block), "found")
    partners = found.filter("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("partners"))
    group = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "cid")
    rooted = classes.select("cid", "label", "digest", "n", "least").join(partners, "cid", "left").join(group, "cid", "left").withColumn("root", F.coalesce("component", "cid"))
    least = rooted.groupBy("root").agg(F.min("least").alias("first"))
    named = rooted.join(least, "root").select(
        "label", "digest", (F.col("n") - 1 + F.coalesce("partners", F.lit(0))).alias("links"), "first", F.lit(True).alias("used"))
    return rows.select("vec_id", "label", "digest").join(named, ["label", "digest"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("used"), F.col("first")).otherwise(F.col("vec_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
