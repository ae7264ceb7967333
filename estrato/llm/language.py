"""Language of whole texts by the nearest of several centroids per language.

A text is a vector of hashed character n-grams (one to three, within words): damped counts times
inverse document frequency, of length one. The frequencies come from all texts that may be learned
from. Per language, the vectors of a bounded sample are clustered by cosine; a text takes the language
of its nearest centroid, and is rejected if even that one is further away than texts of the language
ever are, or if there is nothing to compare.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import mixed, record_batch, sliced, slices

FEATURES = 1 << 14
CENTROIDS = 4
SAMPLE = 800
"""Texts per language that centroids are fitted on, about; a documented bound for training only."""
RADIUS = 0.25
"""A text is rejected below this share of the least similarity seen in the sample (its 1 % quantile):
a text of one word has few of its language's n-grams and is far from any centroid, a text in an
unknown script has none."""
SHARPNESS = 20.0
MODEL_BYTES = 512 << 20
SLICE_BYTES = 1 << 18
UNKNOWN = "und"

FIELDS = {"lang_pred": "string", "score": "double", "similarity": "double", "rejected": "boolean"}


@functools.cache
def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature, count) of each text, features ascending; no letters give none."""
    joined = "\n".join(x.lower() for x in texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.fromiter((len(x.lower()) + 1 for x in texts), np.int64, len(texts)).cumsum()
    letters = np.where(letter_table()[codes], codes, 0).astype(np.uint64)
    pad = np.concatenate((letters, np.zeros(2, np.uint64)))
    a, b, c = pad[:-2], pad[1:-1], pad[2:]
    one = mixed(a) >> np.uint64(50)
    two = mixed(a | b << np.uint64(21)) >> np.uint64(50)
    three = mixed(a | b << np.uint64(21) | c << np.uint64(42)) >> np.uint64(50)
    grams = np.stack([one, two, three])  # FEATURES is 2**14
    # one: a letter; two: letters, or a word's end; three: around a letter in the middle, so word ends count
    ok = np.stack([a > 0, (a > 0) | (b > 0), b > 0])
    start = 0
    for end in ends.tolist():
        counts = np.bincount(grams[:, start : end - 1][ok[:, start : end - 1]].astype(np.int64), minlength=FEATURES)
        seen = np.flatnonzero(counts)
        yield seen, counts[seen]
        start = end


def weighted(seen: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = ((1 + np.log(counts)) * idf[seen]).astype(np.float32)
    return values / np.sqrt((values * values).sum()) if len(values) else values


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all texts each feature occurs; one bounded vector per task is all that travels."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for _, _, texts in sliced(batch.column(0), SLICE_BYTES):
                for seen, _ in features([x.decode() for x in texts]):
                    total[seen] += 1
                    n += 1
        yield record_batch(pa.schema([("k", pa.int64()), ("n", pa.int64())]), np.append(np.flatnonzero(total), -1), np.append(total[total > 0], n))

    out, n = np.zeros(FEATURES, np.int64), 0
    for k, count_k in docs.select(F.col("text").cast("string")).mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n")).collect():
        if k < 0:
            n = count_k
        else:
            out[k] = count_k
    return out, n


def clustered(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centroids of length one by spherical k-means; starts from texts far from each other."""
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(chosen) < min(k, len(x)):
        near = (x @ x[chosen].T).max(axis=1)
        chosen.append(int(np.argmin(near)))
    centers = x[chosen].copy()
    for _ in range(rounds):
        own = np.argmax(x @ centers.T, axis=1)
        for j in range(len(centers)):
            if (own == j).any():
                total = x[own == j].sum(axis=0)
                centers[j] = total / max(np.sqrt((total * total).sum()), 1e-12)
    return centers


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]
    owner: np.ndarray  # language number of each centroid
    centroids: np.ndarray
    floor: np.ndarray  # least similarity per language

    def classify(self, seen: np.ndarray, counts: np.ndarray) -> tuple[str, float, float, bool]:
        if not len(seen) or not len(self.owner):
            return UNKNOWN, 0.0, 0.0, True
        near = self.centroids[:, seen] @ weighted(seen, counts, self.idf)
        best = np.full(len(self.languages), -1.0)
        np.maximum.at(best, self.owner, near.astype(np.float64))
        top = int(np.argmax(best))
        share = 1.0 / np.exp((best - best[top]) * SHARPNESS).sum()
        return self.languages[top], float(share), float(max(0.0, best[top])), bool(best[top] < self.floor[top])


def fit(docs: DataFrame, learnable: Column, lang: str = "lang", sample: int = SAMPLE, centroids: int = CENTROIDS, radius: float = RADIUS) -> Model:
    """Learns from rows where `learnable` holds, `lang` is not NULL and text has letters.

    Document frequencies cover all of those rows; centroids use about `sample` rows per language, chosen
    by a hash of the id. The model is a few hundred KB per language; beyond MODEL_BYTES it is refused.
    """
    rows = docs.filter(learnable).select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).filter("lang is not null and text is not null")
    frequency, n = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    spark, most = docs.sparkSession, MODEL_BYTES // (4 * FEATURES)
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(most + 1).collect()
    if len(sizes) * centroids > most:
        raise ValueError(f"{lang} has too many values for one model; give fewer centroids")
    # one row per language that fits the model; the rows themselves travel only once they are chosen
    shares = F.broadcast(spark.createDataFrame(sizes, "lang string, n long"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 40)) < F.lit(sample) / F.col("n") * (1 << 40)
    shared = spark.sparkContext.broadcast(idf)

    def learn(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        schema = pa.schema([("lang", pa.string()), ("centroid", pa.binary()), ("floor", pa.float64())])
        texts = [t for t in rows.column("text").to_pylist() if any(map(str.isalpha, t))]
        if not texts:
            return schema.empty_table()
        x = np.zeros((len(texts), FEATURES), np.float32)
        at = 0
        for lo, hi in slices(texts, SLICE_BYTES):
            for seen, counts in features(texts[lo:hi]):
                x[at, seen] = weighted(seen, counts, shared.value)
                at += 1
        centers = clustered(x, centroids)
        floor = float(np.quantile((x @ centers.T).max(axis=1), 0.01)) * radius
        return pa.table([[key[0].as_py()] * len(centers), [c.tobytes() for c in centers], [floor] * len(centers)], schema=schema)

    learned = rows.join(shares, "lang").filter(part).select("lang", "text").groupBy("lang").applyInArrow(learn, "lang string, centroid binary, floor double")
    found = sorted(map(tuple, learned.collect()))
    languages = sorted({r[0] for r in found})
    number = {x: i for i, x in enumerate(languages)}
    return Model(
        idf, languages, np.array([number[r[0]] for r in found], np.int64),
        np.stack([np.frombuffer(r[1], np.float32) for r in found]) if found else np.zeros((0, FEATURES), np.float32),
        np.array([next(r[2] for r in found if r[0] == x) for x in languages]),
    )


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` (any columns, text among them) with lang_pred, score, similarity and rejected.

    lang_pred is a learned language; `und` for NULL and for texts without a letter, which are rejected
    with score 0. score is the best language's share (0 to 1), similarity the cosine to its nearest
    centroid. With nothing learned all is `und`. Added columns replace columns of the same names.
    """
    docs = docs.drop(*FIELDS)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.classify(*f) for _, _, texts in sliced(batch.column("text").cast(pa.string()), SLICE_BYTES) for f in features([x.decode() for x in texts])]
            columns = zip(*found) if found else [()] * 4
            more = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *FIELDS])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{n} {t}" for n, t in FIELDS.items()]
    return docs.mapInArrow(run, ", ".join(fields))
