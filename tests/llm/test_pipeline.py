import random

import corpus_pipeline as P
import sentencepiece

from estrato.llm import language
from estrato.llm.common import crc_fold
from tests.llm import test_copies, test_decontaminate, test_lines

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute(spark, rows, sf_dir):
    """The stages on the driver; the language model is the stage's own, as brute force has no other."""
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), crc_fold("doc_id", 4) != 2)
    verdict = [model.classify(*f) for f in language.features([t or "" for _, t, *_ in rows])]
    docs = [(d, t, lang if lang is not None else v[0]) for (d, t, lang, *_), v in zip(rows, verdict) if not v[3]]
    docs.sort()
    left = {d: (t, n, gone) for d, t, n, gone in test_lines.brute([(d, t) for d, t, _ in docs], 2)}
    docs = [(d, left[d][0], lang) for d, _, lang in docs if left[d][2] == 0 or left[d][2] < left[d][1]]
    groups = test_copies.parts([d for d, _, _ in docs], test_copies.brute([(d, t) for d, t, _ in docs]))
    heads = {g[0] for g in groups}
    docs = [x for x in docs if x[0] in heads]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {d for d, _, hits, _ in test_decontaminate.brute([(d, t) for d, t, _ in docs], items) if hits}
    library = sentencepiece.SentencePieceProcessor(model_file=P.PIECE_MODEL)
    return sorted((d, lang, library.encode(t)) for d, t, lang in docs if d not in dirty)


def test_given_documents_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).collect()]
    got = P.run(spark, SF).collect()
    assert sorted((r.doc_id, r.lang, r.piece_ids) for r in got) == brute(spark, rows, SF)
    assert all(r.round_trip for r in got) and len(got) < len(rows)


def stages(spark, docs, sf_dir=SF):
    out = []
    for name, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
        out.append((name, docs))
    return out


def test_edges_in_every_stage(spark, spiky_rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row long, n_words long"
    rng = random.Random(6)
    more = [(700 + k, " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "epsilon"], k=30))) for k in range(40)]
    docs = spark.createDataFrame([(d, t, None if d == 2 else "en", None, None, 1, 2) for d, t in spiky_rows + more], schema)
    for name, stage in P.STAGES:
        found = stage(spark, docs, SF)
        assert found.columns[0] == "doc_id" and found.count() <= docs.count(), name
        if (name, stage) != P.STAGES[-1]:
            assert found.columns == COLUMNS, name
    kept = {r.doc_id for r in stages(spark, docs)[-1][1].collect()}
    assert 700 in kept and len(kept & set(range(10, 50))) <= 1 and 1 not in kept


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert all(found.count() == 0 for _, found in stages(spark, docs))


def test_one_of_each_group_stays_and_equal_rows_collapse(spark):
    text = "some words that are long enough to be a document of its own in this small table"
    rows = [(5, text), (5, text), (9, text.upper()), (None, text), (7, "quite another one"), (None, "without id"), (None, "without id")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = P.one_per_group(spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(5, text), (7, "quite another one"), (None, "without id")], key=str)
