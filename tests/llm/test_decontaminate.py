import random
import re

from estrato.llm import decontaminate

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def brute(rows, items, size=10):
    windows = {}
    for item, text in items:
        own = words(text)
        n = min(size, len(own))
        for s in range(len(own) - n + 1) if n else ():
            windows.setdefault(tuple(own[s : s + n]), set()).add(item)
    out = []
    for doc, text in rows:
        own, hits, ids = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for s in range(len(own) - n + 1):
                if (found := windows.get(tuple(own[s : s + n]))) is not None:
                    hits.update(range(s, s + n))
                    ids |= found
        out.append((doc, len(own), sorted(hits), sorted(i for i in ids if i is not None)))
    return sorted(out, key=str)


def found(docs, items, **more):
    return sorted(((r.doc_id, r.n_words, list(r.hits), list(r["items"])) for r in decontaminate.contamination(docs, items, **more).collect()), key=str)


def sample():
    rng = random.Random(11)
    vocabulary = [a + b for a in "abcdé" for b in ["x", "Y", "zz", "ñ7"]]
    items = [(k, rng.choice([" ", ", ", "-"]).join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 9, 10, 11, 30])))) for k in range(60)]
    items += [(3, items[7][1]), (None, items[9][1]), (None, "only here " * 6), (70, None)]
    rows = []
    for k in range(150):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 15))) for _ in range(3)]
        if k % 3 == 0:
            parts.insert(1, rng.choice(items)[1] or "")
        if k % 5 == 0:
            parts.insert(2, "ONLY here " * 5)
        rows.append((k, " ".join(parts)))
    return rows, items


def test_against_brute_force(spark, make_docs):
    rows, items = sample()
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, hits string")
    assert found(make_docs(rows), frame) == brute(rows, items)


def test_blocks_give_the_same(spark, make_docs):
    rows, items = sample()
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert found(make_docs(rows), frame, block_bytes=700) == brute(rows, items)
    dirty = {d for d, _, hits, _ in brute(rows, items) if hits}
    clean = decontaminate.clean_documents(make_docs(rows), frame, block_bytes=700)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(range(150)) - dirty) and clean.columns == make_docs(rows).columns


def test_edges(spark, make_docs, spiky_rows):
    items = [(1, "a b c"), (2, "word " * 12), (3, "")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert found(make_docs(spiky_rows), frame) == brute(spiky_rows, items)
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(make_docs(spiky_rows), none) == brute(spiky_rows, [])
    assert found(make_docs([]), frame) == []


def test_prefix_is_the_rarest_token(spark, make_docs):
    block = [(1, b"common common rare common common common common common common common")]
    windows = decontaminate.windows_of(block, 10)
    import numpy as np

    vocabulary = np.unique(np.concatenate(windows.tokens))
    counts = decontaminate.token_counts(make_docs([(k, "common " * 5 + ("rare" if k == 0 else "")) for k in range(9)]), vocabulary)
    assert sorted(counts.tolist()) == [1, 45] and decontaminate.index_of(windows, vocabulary, counts).place.tolist() == [2]
