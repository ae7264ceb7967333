import numpy as np

from estrato.llm import embeddings

COLUMNS = "vec_id long, embedding array<float>, label int, n long, leaf string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, c, 1, "x") for i, v, c in rows], COLUMNS).repartition(3)


def usable(v, label):
    return label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, threshold=0.93):
    links = [set() for _ in rows]
    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if usable(v, c) else None for _, v, c in rows]
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i].add(j)
                links[j].add(i)
    return links


def components(rows, links):
    label = list(range(len(rows)))
    for i in range(len(rows)):
        todo = [i] if label[i] == i else []
        while todo:
            for j in links[todo.pop()]:
                if label[j] > i:
                    label[j] = i
                    todo.append(j)
    least = {}
    for (vec, _, _), x in zip(rows, label):
        if vec is not None:
            least[x] = min(vec, least.get(x, vec))
    return [least.get(x) for x in label]


def clustered(seed, n, groups, size=24):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((groups, size))
    own = centers[rng.integers(0, groups, n)] + rng.standard_normal((n, size)) * rng.choice([0.05, 0.25, 2.0], (n, 1))
    return [(1000 + k, [float(np.float32(x)) for x in v], int(k % 3 == 0)) for k, v in enumerate(own)]


def test_one_leaf_is_exact(spark):
    rows = clustered(1, 250, 12)
    rows += [(5 + k, rows[0][1], rows[0][2]) for k in range(60)] + [(80, [2 * x for x in rows[0][1]], rows[0][2])]
    one = [1.0] + [0.0] * 23
    rows += [(1, None, 0), (2, [], 0), (3, [0.0] * 24, 0), (4, [None, 1.0], 0), (90, [float("nan")] * 24, 0), (91, [float("inf")] + one[1:], 0), (92, one, None), (92, one, None), (93, one[:5], 0), (None, one, 0), (None, one, 7), (94, one, 0), (94, one, 0), (95, [1e30] + one[1:], 0)]
    links = brute(rows)
    want = sorted(((v, len(x), c, v == c) for (v, _, _), x, c in zip(rows, links, components(rows, links))), key=str)
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(vectors(spark, rows)).collect()), key=str) == want


def test_recall_of_the_forest_with_split_leaves_and_blocks(spark):
    rows = clustered(2, 1500, 25)
    links = brute(rows)
    want = {v: len(x) for (v, _, _), x in zip(rows, links)}
    found = embeddings.near_duplicates(vectors(spark, rows), leaf=60, block=40, route_rows=200).collect()
    have = {r.vec_id: r.n_links for r in found}
    assert have.keys() == want.keys() and all(have[v] <= want[v] for v in want)
    assert sum(have.values()) >= 0.95 * sum(want.values()) > 0


def test_leaf_that_cannot_be_split_is_compared_in_blocks(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    rows = [(k, [float(np.float32(x)) for x in base + rng.standard_normal(16) * 0.01], 1) for k in range(400)]
    found = embeddings.near_duplicates(vectors(spark, rows), leaf=50, block=30, route_rows=100).collect()
    assert all(r.component_id == 0 for r in found) and sum(r.n_links for r in found) >= 0.95 * 400 * 399
    assert all(r.n_links <= 399 for r in found)


def test_no_vectors(spark):
    assert embeddings.near_duplicates(vectors(spark, [])).count() == 0
