import random

from estrato.llm.components import components


def brute(links):
    label = {n: n for pair in links for n in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def found(spark, links):
    frame = spark.createDataFrame(links, "x long, y long").repartition(3)
    label = {r[0]: r[1] for r in components(frame).collect()}
    return {n: label.get(n, n) for pair in links for n in pair}


def test_random_graph_chain_and_star(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    links += [(1000 + k, 1001 + k) for k in range(120)] + [(2000, 2001 + k) for k in range(200)] + [(7, 7)]
    rng.shuffle(links)
    assert found(spark, links) == brute(links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
