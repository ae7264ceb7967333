import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from estrato.llm import ranking
from tests.llm.test_queries_sql import same_as_sql

DOCS = "doc_id long, text string, score long, n long, terms string, item long"
ITEMS = "item_id long, text string, rank int, weights string"


def terms(text):
    return [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, top=10):
    counts = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 10 + (90 * sum(c.values()) * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1)]
    return sorted(out, key=str)


def corpus(rng, many):
    words = [f"w{k}" for k in range(60)] + ["É", "é", "Straße", "x2", "中文"]
    weights = [1 / (k + 1) for k in range(len(words))]
    docs = [(rng.randrange(many), "-".join(rng.choices(words, weights, k=rng.choice([1, 4, 30, 200]))).upper()) for _ in range(many)]
    docs += [(None, "w1 w2 w3"), (None, "w59"), (3, "w1 w2 w3"), (3, "w1 w2 w3"), (9, ""), (10, None), (11, " .,-\n"), (12, "w7 " * 50_000), (13, " ".join(f"v{k}" for k in range(20_000)))]
    docs += [(5000 + k, "w4 w40 w41 same") for k in range(40)]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 3, 12])))) for k in range(30)] + [(1, "w1 w2"), (None, "w3"), (77, None), (78, ""), (79, "unknown words"), (80, "same"), (80, "SAME v17 w59")]
    return docs, items


@pytest.mark.parametrize("top, batch", [(10, 1 << 17), (3, 20), (1000, 50)])
def test_against_brute_force(spark, top, batch):
    docs, items = corpus(random.Random(top), 300)
    index = ranking.Index(spark.createDataFrame([(*d, 1, 1, "x", 1) for d in docs], DOCS).repartition(4))
    got = ranking.best_documents(index, spark.createDataFrame([(*i, 1, "x") for i in items], ITEMS), top, batch).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items, top)


def test_bounds_hold_and_stop_the_search(spark):
    rng = random.Random(1)
    texts = [" ".join(f"t{int(rng.paretovariate(0.6))}" for _ in range(rng.choice([20, 150]))) for _ in range(400)]
    index = ranking.Index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    items = ranking.numbered(spark.createDataFrame([(k, texts[k][:60]) for k in range(20)], "item_id long, text string"))
    (held,) = ranking.batches_of(items, 1 << 17)
    batch = index.batch(held)
    tight = 0
    for r in index.rows.collect():
        sketch = np.frombuffer(r.sketch, np.uint8)[None, :]
        terms, counts = ranking.unpacked(r.terms, r.counts)
        own = batch.impacts(terms, ranking.impact(counts, np.int64(r.n), index.documents, index.length))
        bounds, scores = batch.bounds(sketch)[0], [batch.score(k, own) for k in range(len(batch.item))]
        assert all(b >= s for b, s in zip(bounds.tolist(), scores))
        tight += sum(b < 1.5 * s + 10**8 for b, s in zip(bounds.tolist(), scores))
    assert tight > 0.5 * 20 * len(texts)


def test_no_documents_or_items(spark):
    none = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b", 1, 1, "x", 1)], DOCS), spark.createDataFrame([(1, "a", 1, "x")], ITEMS)
    for docs, items in ((none[0], none[1]), (none[0], some[1]), (some[0], none[1])):
        assert ranking.best_documents(ranking.Index(docs), items).count() == 0


def test_query_against_sql(spark):
    same_as_sql(spark, "op12_ranked_search")
