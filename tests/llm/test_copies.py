import random

import corpus_pipeline as P

from estrato.llm import copies, simhash

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def grams(text):
    words = (text or "").encode().translate(LOWER).split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def brute(rows):
    """Groups as sorted lists of row numbers."""
    sets = [grams(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def parts(keys, labels):
    groups = {}
    for k, x in zip(keys, labels):
        groups.setdefault(x, []).append(k)
    return sorted(map(sorted, groups.values()))


def changed(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(rng, many):
    rows = []
    for length in (30, 100, 300):
        for _ in range(12):
            base = [f"w{rng.randrange(5000)}" for _ in range(length)]
            rows += [changed(rng, base, n) for n in (0, length // 100, length // 50, length // 30, length // 12)]
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows += [changed(rng, base, rng.randint(1, 4)) for _ in range(many)]
    return rows + ["", "  ", "a b", "A b", "a b c d e", "a b c d e f", "x " * 50, "x " * 5]


def found(docs):
    got = copies.near_copies(docs).collect()
    return parts([r.doc_id for r in got], [r.root for r in got])


def test_against_brute_force_with_small_and_large_bands(make_docs, monkeypatch):
    rng = random.Random(11)
    rows = list(enumerate(corpus(rng, 90))) + [(9000, None)]
    want = parts([d for d, _ in rows], brute(rows))
    assert found(make_docs(rows)) == want
    monkeypatch.setattr(copies, "FEW", 2)
    assert found(make_docs(rows)) == want
    monkeypatch.setattr(copies, "PIVOTS", 1)
    assert found(make_docs(rows)) == want


def crowd(rng, many):
    """Texts around one base: most are no copies of each other, some are."""
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    loose = [changed(rng, base, rng.randint(3, 8)) for _ in range(many)]
    return loose + [changed(rng, x.split(), rng.randint(0, 2)) for x in rng.sample(loose, many // 8)]


def test_loose_crowd_is_exact_and_needs_pairs_in_proportion(make_docs):
    verified = {}
    for many in (400, 800):
        rows, tables = list(enumerate(crowd(random.Random(4), many))), []
        got = copies.near_copies(make_docs(rows), tables.append).collect()
        if many == 400:
            assert parts([r.doc_id for r in got], [r.root for r in got]) == parts([d for d, _ in rows], brute(rows))
        verified[many] = [t.count() for t in tables]
    assert len(verified[800]) == 2 and all(b < 2.5 * a for a, b in zip(verified[400], verified[800])), verified


def test_empty(make_docs):
    assert found(make_docs([])) == []


def test_stage_catches_near_copies_beyond_two_bits(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts = [" ".join(base), changed(rng, base, 5), changed(rng, base, 30)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in P.one_per_group(spark, docs, "").collect()) == [0, 2]


def test_one_of_a_group_without_ids_or_under_one_id_stays(spark):
    rng = random.Random(7)
    rows = []
    for doc in (None, 5):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        rows += [(doc, changed(rng, base, n)) for n in (0, 2, 4)] * 2
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows += [(None, " ".join(base)), (8, changed(rng, base, 3)), (9, changed(rng, base, 3))]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in P.one_per_group(spark, docs, "").collect()]
    assert sorted((d for d, _ in got), key=str) == [5, 8, None] and set(got) <= set(rows)


def test_simhash_groups_are_verified_and_suffice_without_bands(make_docs, monkeypatch):
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1])), (3, " ".join(base) + " " + base[0]), (4, changed(rng, base, 60)), (5, None), (6, "")]
    docs, groups = make_docs(rows), []
    fp = {r.doc_id: r.component_id for r in copies.near_duplicates(docs).collect()}
    assert fp[1] == fp[2] == fp[3] != fp[4]
    monkeypatch.setattr(copies, "_band_pairs", lambda shared: shared.sparkSession.createDataFrame([], "a long, b long"))
    assert found(docs) == [[1, 2, 3], [4], [5, 6]]


def jaccard(x, y):
    return len(grams(x) & grams(y)) / len(grams(x) | grams(y))


def bits(x, y):
    return (simhash.fingerprint_of(x.encode()) ^ simhash.fingerprint_of(y.encode())).bit_count()


def fingerprint_copy(rng, words, most, among):
    """A text within two bits of `words` whose 5-word similarity is below 0.8, by changing words of the places `among`."""
    text = " ".join(words)
    while True:
        copy = list(words)
        for at in rng.sample(among, most):
            copy[at] = f"new{rng.randrange(10**6)}"
        if bits(text, " ".join(copy)) <= 2:
            assert jaccard(text, " ".join(copy)) < 0.8
            return " ".join(copy)


def brute_of_both_rules(rows):
    label = brute(rows)
    for i in range(len(rows)):
        for j in range(i):
            if bits(rows[i][1] or "", rows[j][1] or "") <= 2 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def found_by_both(docs):
    got = copies.near_copies(docs, fingerprints=True).collect()
    return parts([r.doc_id for r in got], [r.root for r in got])


def test_simhash_links_hold_below_the_similarity(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = [(7, " ".join(base)), (3, fingerprint_copy(rng, base, 9, range(5, 295))), (9, changed(rng, base, 60))]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in P.one_per_group(spark, docs, "").collect()) == [3, 9]


def test_both_rules_against_brute_force(make_docs):
    rng = random.Random(8)
    rows = list(enumerate(corpus(rng, 20)))
    for doc in (800, 900):  # a copy by fingerprint that has a copy by similarity, which has one by fingerprint
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        first = fingerprint_copy(rng, base, 9, range(5, 295))
        second = changed(rng, first.split(), 3)
        rows += [(doc, " ".join(base)), (doc + 1, first), (doc + 2, second), (doc + 3, fingerprint_copy(rng, second.split(), 9, range(5, 295)))]
    rows += [(9000, None), (9001, " ")]
    want = parts([d for d, _ in rows], brute_of_both_rules(rows))
    assert [800, 801, 802, 803] in want and [900, 901, 902, 903] in want
    assert found_by_both(make_docs(rows)) == want


def test_every_fingerprint_of_equal_sets_links(make_docs):
    rng = random.Random(1)
    cycle = [f"w{k}" for k in range(300)]
    once, partly = cycle + cycle[:4], cycle + cycle[:160]
    assert grams(" ".join(once)) == grams(" ".join(partly)) and bits(" ".join(once), " ".join(partly)) > 2
    copies_of_both = [fingerprint_copy(rng, once, 9, range(5, 295)), fingerprint_copy(rng, partly, 9, range(170, 290))]
    rows = list(enumerate([" ".join(once), " ".join(partly), *copies_of_both, "quite another text than these"]))
    assert found_by_both(make_docs(rows)) == [[0, 1, 2, 3], [4]]


def test_simhash_groups_under_one_id_stay_apart(make_docs):
    rng = random.Random(9)
    rows = []
    for k in range(2):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        for doc in ((5, 10 + k), (None, None)):
            words = base if doc[0] else [f"v{rng.randrange(5000)}" for _ in range(300)]
            rows += [(doc[0], " ".join(words)), (doc[1], fingerprint_copy(rng, words, 9, range(5, 295)))]
    got = copies.near_copies(make_docs(rows), fingerprints=True).collect()
    assert parts([r.doc_id or 0 for r in got], [r.root for r in got]) == [[0, 0], [0, 0], [5, 10], [5, 11]]
