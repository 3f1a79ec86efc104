"""Components against a plain union-find."""

import random

import pytest

from tessella.operators.graph import components

r = random.Random(3)
GRAPHS = {
    "path": [(i, i + 1) for i in range(30)],
    "random": [(r.randrange(80), r.randrange(80)) for _ in range(60)],
    "star": [(5, i) for i in range(6, 50)] + [(7, 7)],
    "two-sided star": [(40, i) for i in range(20)] + [(60 + i, 40) for i in range(20)],
    "none": [],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in GRAPHS[name]:
        if a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(GRAPHS[name], "u long, v long")).collect()
    assert {x.id: x.root for x in got} == {x: find(x) for x in up} and len(got) == len(up)
