"""Components of random graphs, paths, stars and cliques."""

import random

import pytest
import test_queries as tq

from folioflow.llm.components import connected


def random_graph(seed):
    r = random.Random(seed)
    return [(r.randrange(60), r.randrange(60)) for _ in range(45)]


GRAPHS = {
    "path": [(i, i + 1) for i in range(40)], "reversed path": [(i + 1, i) for i in range(30)], "star": [(7, i) for i in range(30)],
    "clique": [(i, j) for i in range(12) for j in range(i)], "loops": [(1, 1), (2, 3), (3, 2), (2, 3)], "none": [], "random": random_graph(1), "other": random_graph(2),
}


@pytest.mark.parametrize("name", sorted(GRAPHS))
def test_components(spark, name):
    edges = GRAPHS[name]
    links = {}
    for a, b in edges:
        if a != b:
            links.setdefault(a, set()).add(b)
            links.setdefault(b, set()).add(a)
    rows = connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(rows) == len(links) and {r["node"]: r["root"] for r in rows} == tq.components(links)
