import random

import pytest

from kinfold.operators.closure import connected_components


def components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def random_edges(seed):
    r = random.Random(seed)
    return [(f"{r.randrange(90):03d}", f"{r.randrange(90):03d}") for _ in range(60)]


@pytest.mark.parametrize("hot_rows", [3, 1_000_000])
@pytest.mark.parametrize(
    "edges",
    [
        [(f"{i:03d}", f"{i + 1:03d}") for i in range(40)],
        [("hub", f"{i:03d}") for i in range(40)] + [("zz", "hub")],
        random_edges(1),
    ],
    ids=["path", "hub", "random"],
)
def test_components(spark, edges, hot_rows):
    edges = [e for e in edges if e[0] != e[1]]
    df = spark.createDataFrame(edges, "u string, v string")
    got = {r.node: r.component for r in connected_components(df, hot_rows).collect()}
    assert got == components(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "u string, v string")).count() == 0


def test_stops_without_fixed_point(spark):
    edges = [(f"{i:03d}", f"{i + 1:03d}") for i in range(50)]
    with pytest.raises(RuntimeError):
        connected_components(spark.createDataFrame(edges, "u string, v string"), max_rounds=1)
