import random

import numpy as np
import pytest

from estrato.llm import common, substrings


def brute(rows, window):
    first = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for s in range(len(words) - window + 1):
            if doc is not None and first[tuple(words[s : s + window])] < doc:
                gone.update(range(s, s + window))
        out.append((doc, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return sorted(out, key=str)


def found(docs, **more):
    rows = substrings.removed_passages(docs, **more).collect()
    for r in rows:
        assert r.n_removed == sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2]))
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows), key=str)


@pytest.mark.parametrize("window", [13, 4, 7])
def test_against_brute_force(make_docs, window):
    rng = random.Random(window)
    passages = [" ".join(rng.choices("abcdefgh", k=rng.randint(5, 40))) for _ in range(12)]
    rows = []
    for k in range(90):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choices("abcdefghijkl", k=rng.randint(0, 25))) for _ in range(rng.randint(0, 5))]
        rows.append((k * 3 % 100, rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(500 + k, passages[0] + " " + passages[1]) for k in range(40)]
    assert found(make_docs(rows), window=window, chunk_bytes=500) == brute(rows, window)


def test_edges(make_docs, spiky_rows):
    rows = spiky_rows + [(4, " ".join(map(str, range(30)))), (4, " ".join(map(str, range(30)))), (None, " ".join(map(str, range(30)))), (3, " ".join(map(str, range(12, 40))))]
    assert found(make_docs(rows)) == brute(rows, 13)


def test_empty(make_docs):
    assert found(make_docs([])) == []


def test_packing():
    values = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    assert (substrings.ungapped(substrings.gaps(values), "u8") == values).all()
    small = np.array([-5, 0, 7, 2**40], np.int64)
    assert (substrings.unpacked(substrings.packed(small), "i8") == small).all()


def test_equal_windows_have_equal_hashes():
    words = common.Words([b"a bb  ccc\td", b"", b"bb ccc d"])
    hashes = words.hashes()
    assert [words.word(i) for i in range(len(words))] == [b"a", b"bb", b"ccc", b"d", b"bb", b"ccc", b"d"]
    for length in range(1, 4):
        run = common.window_hashes(hashes, length)
        assert run[1] == run[4] and len(set(run.tolist())) == len({tuple(hashes[i : i + length].tolist()) for i in range(len(run))})
