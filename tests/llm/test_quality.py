import math
import random

import numpy as np
import zstandard

from estrato.llm import quality, queries
from estrato.llm.common import crc_fold

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = queries.op7_quality_classifier(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    good = sorted(r.score for r in rows if r.quality == 1)
    bad = sorted(r.score for r in rows if r.quality == 0)
    assert good and bad and all(0 <= r.score <= 1 for r in rows)
    assert sum(g > b for g in good for b in bad) >= 0.97 * len(good) * len(bad)
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)


def test_edges(spark, make_docs, spiky_rows):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels, crc_fold("doc_id", 5) != 0)
    found = quality.with_quality(make_docs(spiky_rows), model).collect()
    assert len(found) == len(spiky_rows) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if not r.text}) == 1
    assert quality.with_quality(make_docs([]), model).count() == 0


def test_nothing_or_one_label_to_learn_from(spark, make_docs):
    docs = make_docs([(k, f"text {k} of some length") for k in range(30)])
    for rows in ([], [(k, 1) for k in range(30)], [(k, None) for k in range(30)], [(1, 0), (1, 1)]):
        model = quality.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"), crc_fold("doc_id", 5) != 0)
        found = {r.score for r in quality.with_quality(docs, model).collect()}
        assert len(found) == 1 and 0 < found.pop() < 1


def test_whole_text_counts():
    sizes = quality.Sizes(b"", b"")
    assert len(quality.pieces_of(b"x" * 5000)) == 5 and b"".join(quality.pieces_of(b"ab" * 3000)) == b"ab" * 3000
    assert sizes.measures(b"") == (0.0, 0.0)


def slow(model, text):
    """Sizes piece by piece with a compressor made anew for each, and the curve by its formula."""
    data = (text or "").encode()
    total = model.curve.offset
    if data:
        sizes = []
        for dictionary in (model.good, model.bad):
            size = 0
            for i in range(0, len(data), quality.PIECE):
                tool = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False, write_checksum=False, write_dict_id=False)
                size += len(tool.compress(data[i : i + quality.PIECE]))
            sizes.append(size)
        both = sum(sizes)
        total += model.curve.weights[0] * (sizes[1] - sizes[0]) / both + model.curve.weights[1] * math.log(both / 2 / len(data))
    return 1 / (1 + math.exp(-total))


def test_against_brute_force(spark, make_docs, spiky_rows):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels, crc_fold("doc_id", 5) != 0, sample=200)
    rng = random.Random(5)
    rows = [(d, t[:3000] if t else t) for d, t in spiky_rows] + [(1000 + k, r.text[: rng.choice([10, 1024, 5000])]) for k, r in enumerate(docs.select("text").limit(60).collect())]
    for r in quality.with_quality(make_docs(rows), model).collect():
        assert abs(r.score - slow(model, r.text)) < 1e-9, r.doc_id


def test_curve_against_plain_gradient_descent():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2)) * [0.02, 0.5] + [0.1, -1]
    y = (rng.random(400) < 1 / (1 + np.exp(-(60 * (x[:, 0] - 0.1) + 0.5 * (x[:, 1] + 1))))).astype(float)
    curve = quality.logistic(x, y)
    z = np.column_stack([(x - x.mean(0)) / x.std(0), np.ones(400)])
    w = np.zeros(3)
    for _ in range(20_000):
        w -= 0.01 * (z.T @ (1 / (1 + np.exp(-z @ w)) - y) + 1e-2 * w) / 40
    assert all(abs(curve(tuple(a)) - 1 / (1 + np.exp(-b @ w))) < 1e-3 for a, b in zip(x, z))
