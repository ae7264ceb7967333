import random
import re
from itertools import permutations

import pytest

from estrato.llm import audit, queries
from tests.llm.test_queries_sql import same_as_sql

DOCS = "doc_id long, text string, source string, n long, part string, mask int, h long"
LABELS = "doc_id long, quality int, toxic int, part string"


def fails(rows, doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = {x for x, c in zip("ABCD", (
        len(words) < 50, 100 * len(set(words)) < 65 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 5 * len(text), re.search(r"[#$%&*|]", text) is not None)) if c}
    return out | ({"E"} if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in rows) else set())


def brute(rows, labels):
    """Every order is applied document by document."""
    known = {}
    for doc, good, toxic in labels:
        if doc is not None:
            have = known.get(doc, (0, 0))
            known[doc] = (max(have[0], int(good == 1)), max(have[1], int(toxic == 1)))
    docs = [(s or "", fails(rows, d, t or ""), *known.get(d, (0, 0))) for d, t, s in rows]
    out, shapley = {}, {}
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, x in enumerate(order, 1):
                lost = [d for d in left if x in d[1]]
                redundant = sum(x in d[1] for d in gone)
                left = [d for d in left if x not in d[1]]
                gone += lost
                only = sum(d[1] == {x} for d in docs if d[0] == part)
                out[part, order, step] = [len(left), len(lost), redundant, only, sum(d[2] for d in lost), sum(d[3] for d in lost)]
                shapley[part, x] = shapley.get((part, x), 0) + len(lost)
    return sorted((p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items())


def corpus(rng):
    texts = [" ".join(rng.choices(["ab", "Cd", "EF", "#g", "é", "100%", "x\ty", "zz\n"], weights=[9, 3, 1, 0.1, 5, 0.1, 3, 2], k=rng.choice([3, 49, 50, 60]))) for _ in range(40)]
    texts += [" ".join(f"w{k}" for k in range(n)) for n in (49, 50, 51)] + [" ".join(f"w{k % d}" for k in range(100)) for d in (64, 65, 66)]
    texts += ["A" * a + "é" * (100 - a) for a in (4, 5, 6)] + ["", " \t", None, " " * 60]
    rows = [(rng.randrange(500), rng.choice(texts), rng.choice(["s", "t", "", None])) for _ in range(150)]
    rows += [(None, texts[0], "s")] * 3 + [(7, texts[1], "s")] * 2 + [(1000 + k, "one text in many rows", "hot") for k in range(60)]
    return rows + [(5000, "word " * 50_000, "long")]


@pytest.mark.parametrize("salt, sent", [(500, 1 << 20), (7, 0)])
def test_against_brute_force(spark, monkeypatch, salt, sent):
    monkeypatch.setattr(audit, "ROWS_PER_SALT", salt)
    monkeypatch.setattr(audit, "SENT_ROUND", sent)
    rng = random.Random(3)
    rows = corpus(rng)
    labels = [(rng.randrange(500), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(300)] + [(None, 1, 1)] + [(1000 + k, 1, k % 2) for k in range(50)]
    docs = spark.createDataFrame([(*r, 1, "x", 1, 1) for r in rows], DOCS).repartition(3)
    got = audit.filter_interactions(docs, spark.createDataFrame([(*x, "y") for x in labels], LABELS)).collect()
    assert sorted(map(tuple, got)) == brute(rows, labels)


def test_no_documents(spark):
    assert audit.filter_interactions(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0


def test_query_against_sql(spark):
    same_as_sql(spark, "op13_filter_interactions")


def test_registered():
    assert "op13_filter_interactions" in queries.QUERIES and "op13_filter_interactions" in queries.ORACLE_SQL
