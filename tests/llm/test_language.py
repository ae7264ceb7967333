import math
import random
from collections import Counter

import numpy as np

from estrato.llm import language, queries
from estrato.llm.common import crc_fold

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = queries.op3_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert found.count() == 1000
    held = found.filter("held_out and lang is not null")
    assert held.filter("lang_pred = lang").count() >= 0.97 * held.count() > 0
    assert found.filter("score < 0 or score > 1 or rejected").count() == 0


def test_edges_and_rejection(spark, make_docs, spiky_rows):
    model = language.fit(spark.read.parquet(f"{SF}/documents.parquet"), crc_fold("doc_id", 4) != 2)
    rows = [*spiky_rows, (900, "12 34 !?"), (901, "Съешь ещё этих мягких французских булок"), (902, "漢字の文章です、これは")]
    found = language.with_language(make_docs(rows), model).collect()
    assert len(found) == len(rows)
    for r in found:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und") == (not letters) and (letters or (r.rejected and r.score == 0))
        assert r.doc_id not in (901, 902) or r.rejected
    assert language.with_language(make_docs([]), model).count() == 0


def test_nothing_to_learn_from(make_docs):
    docs = make_docs([(1, "some text"), (2, None)]).withColumn("lang", crc_fold("doc_id", 4).cast("string")).filter("doc_id < 0")
    model = language.fit(docs, crc_fold("doc_id", 4) >= 0)
    assert [r.lang_pred for r in language.with_language(make_docs([(1, "some text")]), model).collect()] == ["und"]


def test_lang_column_is_no_input_of_a_prediction(spark, make_docs):
    model = language.fit(spark.read.parquet(f"{SF}/documents.parquet"), crc_fold("doc_id", 4) != 2)
    text = spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'de'").head().text
    assert language.with_language(make_docs([(1, text)]), model).head().lang_pred == "de"


def slot(*letters):
    """The slot of one n-gram, by whole-number arithmetic."""
    x = sum(ord(c) << 21 * k for k, c in enumerate(letters) if c) & (1 << 64) - 1
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x ^= x >> 33
        x = x * factor & (1 << 64) - 1
    return (x ^ x >> 33) >> 50


def grams(text):
    """Counts by slot: letters, pairs with a letter on either side, and triples around a letter."""
    own = [c if c.isalpha() else "" for c in text.lower()] + ["", ""]
    out = Counter()
    for a, b, c in zip(own, own[1:], [*own[2:], ""]):
        out.update([slot(a)] * bool(a) + [slot(a, b)] * bool(a or b) + [slot(a, b, c)] * bool(b))
    return out


def slow(model, text):
    """Nearest centroid by plain sums, one text at a time."""
    counts = grams(text) if text else {}
    if not any(map(str.isalpha, text or "")):
        return "und", 0.0, True
    weights = {k: (1 + math.log(n)) * float(model.idf[k]) for k, n in counts.items()}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    best = {}
    for owner, center in zip(model.owner.tolist(), model.centroids):
        best[owner] = max(best.get(owner, -1.0), sum(w / norm * float(center[k]) for k, w in weights.items()))
    top = min(best, key=lambda k: (-best[k], k))
    return model.languages[top], 1 / sum(math.exp((v - best[top]) * language.SHARPNESS) for v in best.values()), best[top] < model.floor[top]


def test_against_brute_force(spark, make_docs, spiky_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs, crc_fold("doc_id", 4) != 2)
    rng = random.Random(2)
    texts = [r.text for r in docs.select("text").limit(60).collect()]
    rows = [(d, (t or "")[:400] if t else t) for d, t in spiky_rows] + [(1000 + k, t[: rng.choice([5, 60, 900])]) for k, t in enumerate(texts)]
    rows += [(2000, "ÀÉ x1y' İß\n中文"), (2001, "Съешь ещё"), (2002, "a")]
    for r in language.with_language(make_docs(rows), model).collect():
        lang, score, rejected = slow(model, r.text)
        assert (r.lang_pred, r.rejected) == (lang, rejected) and abs(r.score - score) < 1e-3, (r.doc_id, lang, score)


def test_document_frequencies_against_brute_force(make_docs):
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcé -1\n", k=rng.randint(0, 40))) for _ in range(200)] + ["", "a"]
    frequency, n = language.document_frequencies(make_docs(list(enumerate(texts))).select("text"))
    want = Counter(k for t in texts for k in set(grams(t)) if any(map(str.isalpha, t)))
    assert n == len(texts) and {k: int(v) for k, v in enumerate(frequency) if v} == dict(want)
    assert np.count_nonzero(frequency) == len(want)
