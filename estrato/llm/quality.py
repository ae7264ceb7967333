"""Text quality by compression: which of two dictionaries, good or bad, makes a text smaller.

A zstandard dictionary is built from a bounded sample of each label's texts. A text is compressed in
pieces of equal size, so that a long text is judged over its whole length and not by its beginning;
the difference of the two total sizes, over their sum, is the main measure, and how far the text was
compressed at all the second (endless repetition). A logistic curve fitted on other labelled texts
turns both into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import encoded, sliced, stored

DICTIONARY = 112 << 10
SAMPLE = 3000
"""Texts per label for the dictionaries, about, and as many again for the curve."""
SAMPLE_BYTES = 16 << 20
"""Text per label that a dictionary is built from at most; whole pieces of evenly spread texts."""
PIECE = 1024
LEVEL = 3

FIELDS = {"score": "double", "difference": "double"}


def pieces_of(text: bytes, size: int = PIECE) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)]


def dictionary_of(texts: list[bytes], size: int = DICTIONARY, most: int = SAMPLE_BYTES) -> bytes:
    """A zstandard dictionary; the texts themselves where there are too few to train one."""
    parts = [p for t in texts for p in pieces_of(t)]
    step = max(1, -(-sum(map(len, parts)) // most))
    parts = parts[::step]
    try:
        return zstandard.train_dictionary(size, parts, k=256, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-size:]


@dataclass
class Sizes:
    """Compressors with the two dictionaries."""

    good: bytes
    bad: bytes

    def __post_init__(self) -> None:
        self.tools = []
        for data in (self.good, self.bad):
            known = zstandard.ZstdCompressionDict(data) if data else None
            if known:
                known.precompute_compress(level=LEVEL)
            self.tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False))

    def measures(self, text: bytes) -> tuple[float, float]:
        """(difference, log of the compressed share). The difference is over 0 where the good dictionary
        makes the text smaller; no text has 0 for both."""
        if not text:
            return 0.0, 0.0
        good, bad = (sum(len(tool.compress(p)) for p in pieces_of(text)) for tool in self.tools)
        return (bad - good) / (bad + good), math.log((bad + good) / 2 / len(text))


@dataclass
class Curve:
    weights: tuple[float, ...]
    offset: float

    def __call__(self, measures: tuple[float, ...]) -> float:
        total = self.offset + sum(w * x for w, x in zip(self.weights, measures))
        return 1 / (1 + math.exp(-min(40.0, max(-40.0, total))))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> Curve:
    """A logistic curve by Newton's method with a light penalty; the plain share where there is one label or none."""
    if not len(x) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Curve((0.0,) * x.shape[1], math.log(share / (1 - share)))
    middle, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - middle) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w)), z.T @ (p - y) + 1e-2 * w)
        w -= np.clip(step, -3, 3)
    slope = w[:-1] / scale
    return Curve(tuple(slope.tolist()), float(w[-1] - slope @ middle))


@dataclass
class Model:
    good: bytes
    bad: bytes
    curve: Curve


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learns from documents where `learnable` holds and `label` is 0 or 1.

    About `sample` texts per label build a dictionary, as many others fit the curve; a hash of the id
    chooses. Documents with contradictory labels are left out; repeated labels count once.
    """
    marks = labels.filter(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("most")).filter("y = most").select("doc_id", F.col("y").cast("int").alias("y"))
    marks = marks.filter(learnable)
    sizes = marks.groupBy("y").agg(F.count("*").alias("n"))
    place = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 40)) / (1 << 40)
    share = F.least(F.lit(sample) / F.col("n"), F.lit(0.5))
    # two rows of sizes; about 4 * sample ids and texts by the choice above, checked before they are sent round
    chosen = stored(marks.join(F.broadcast(sizes), "y").select("doc_id", "y", F.when(place < share, 0).when(place < 2 * share, 1).alias("use")).filter("use is not null"), "chosen")
    if chosen.count() > 8 * max(sample, 100):
        raise ValueError("the hash of the ids does not spread them; choose another sample")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    rows = stored(texts.join(F.broadcast(chosen), "doc_id").select("y", "use", "text"), "sample")

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return pa.table([[key[0].as_py()], [dictionary_of(encoded(rows.column("text")))]], schema=pa.schema([("y", pa.int32()), ("d", pa.binary())]))

    found = dict(map(tuple, rows.filter("use = 0").groupBy("y").applyInArrow(build, "y int, d binary").collect()))
    good, bad = (bytes(found.get(y, b"")) for y in (1, 0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(good, bad)
        for batch in batches:
            found = [sizes.measures(t) for t in encoded(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("y"), *(pa.array([f[i] for f in found], pa.float64()) for i in (0, 1))], ["y", "a", "b"])

    # about twice `sample` rows of three numbers
    seen = np.array(rows.filter("use = 1").mapInArrow(measure, "y int, a double, b double").collect(), float).reshape(-1, 3)
    shares = dict(map(tuple, sizes.collect()))
    curve = logistic(seen[:, 1:], seen[:, 0])
    drawn = {y: int((seen[:, 0] == y).sum()) for y in (0, 1)}
    if all(drawn.values()) and all(shares.get(y) for y in (0, 1)):
        # the sample holds both labels about equally; the offset moves to the labels' real shares
        curve.offset += math.log(shares[1] / shares[0]) - math.log(drawn[1] / drawn[0])
    return Model(good, bad, curve)


def with_quality(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` (any columns, text among them) with score (0 to 1, higher is better) and difference.

    Only the text decides. NULL and empty texts have difference 0 and the score that the curve gives it; with
    nothing learned every text has the share of good labels, or a half. Added columns replace columns
    of the same names.
    """
    docs = docs.drop(*FIELDS)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(shared.value.good, shared.value.bad)
        for batch in batches:
            found = [sizes.measures(t) for _, _, texts in sliced(batch.column("text")) for t in texts]
            more = [pa.array([shared.value.curve(x) for x in found], pa.float64()), pa.array([x[0] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *FIELDS])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{n} {t}" for n, t in FIELDS.items()]
    return docs.mapInArrow(run, ", ".join(fields))
