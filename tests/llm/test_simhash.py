import random

import numpy as np
import pyarrow as pa
import xxhash

from estrato.llm import queries, simhash

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc, _), x in zip(rows, label):
        if doc is not None:
            least[x] = min(doc, least.get(x, doc))
    return sorted(((doc, p, least.get(x)) for (doc, _), p, x in zip(rows, prints, label)), key=str)


def found(docs):
    return sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)


def near_copies(rng, n, words=120):
    base = rng.choices([a + b for a in "bcdfg" for b in "aeiou"], k=words)
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(words)] = rng.choice("xyz")
        yield " ".join(copy)


def test_against_brute_force(make_docs, spiky_rows):
    rng = random.Random(3)
    texts = [t for n in (90, 30, 2, 2) for t in near_copies(rng, n)] + [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 6))) for _ in range(80)]
    rows = [(1000 + k, t) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += spiky_rows
    assert found(make_docs(rows)) == brute(rows)


def test_empty(make_docs):
    assert found(make_docs([])) == []


def spread(pairs):
    a, b = simhash.forest(np.asarray(pairs, np.uint64).view(np.int64).reshape(-1, 2))
    return dict(zip(a.tolist(), b.tolist()))


def test_cells_find_every_link_in_small_and_large_groups():
    rng = np.random.default_rng(2)
    values = set(rng.integers(0, 2**63, 60, dtype=np.uint64).tolist())
    for base in list(values)[:6]:
        for _ in range(150):
            x = base
            for bit in rng.integers(0, 64, rng.integers(1, 4)):
                x ^= 1 << int(bit)
            values.add(x)
    fp = np.array(sorted(values), np.uint64)
    links = [(a, b) for i, a in enumerate(fp.tolist()) for b in fp.tolist()[:i] if (a ^ b).bit_count() <= 2]
    want = spread(links)
    for most in (1 << 22, 4000):
        assert spread(np.concatenate(simhash.links_in_large_group(fp, most))) == want
    cells = next(simhash._cells(iter([pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64))], ["fp"])])))
    order = np.lexsort((cells.column(1), cells.column(0)))
    batch = pa.RecordBatch.from_arrays([c.take(pa.array(order)) for c in cells.columns], ["cell", "fp"])
    got = [np.stack([b.column(0), b.column(1)], 1) for b in simhash._links(iter([batch.slice(k, 501) for k in range(0, batch.num_rows, 501)]))]
    assert spread(np.concatenate(got).view(np.uint64)) == want


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op6_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got), key=str) == brute(rows)
