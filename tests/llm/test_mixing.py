"""Source mixing: targets against plain water filling, nearness, whole copies, edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from compare import DATA, connect, differences
from tessella.llm import mixing
from tessella.llm.queries import QUERIES, SQL


def filled(sizes, weights=(1, 2, 3), ceiling=3):
    """Shares by weight, the excess over the ceilings shared again until none is left."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while open_ and left > 1e-9:
        total = sum(w[s] for s in open_)
        give = {s: left * w[s] / total for s in open_}
        left = 0.0
        for s, x in give.items():
            target[s] += x
            if target[s] >= ceiling * sizes[s]:
                left += target[s] - ceiling * sizes[s]
                target[s] = ceiling * sizes[s]
                open_.discard(s)
    return target


def check(rows):
    sizes, taken, most = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        most[r.source] = max(most.get(r.source, 0), r.size)
    want = filled(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r.copies <= 3
    for s, n in taken.items():
        assert abs(n - want[s]) <= most[s] + 1e-6, (s, n, want[s])
    return want


def test_query_equals_sql(spark, sf="sf0.01"):
    assert differences(QUERIES["op11_mixing"](spark, str(DATA / sf)), connect(DATA / sf), SQL["op11_mixing"]) is None


def test_targets_and_nearness(spark):
    rnd = random.Random(5)
    for n in (3, 400):
        rows = [(i, rnd.choice(["a", "b", "B", "", "é", "\U0001f600", None, "hot", "hot", "hot"]), rnd.choice([0, 1, 5, 5, 700])) for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, source string, size long")
        one, two = mixing.mix(df).collect(), mixing.mix(df.repartition(7)).collect()
        check(one)
        assert sorted(map(tuple, one), key=str) == sorted(map(tuple, two), key=str)  # reruns agree
        assert sum(r.copies for r in one) == mixing.emit(mixing.mix(df)).count()


def test_ceiling_stops_every_source(spark):
    # one source far below its weight, one that takes the rest: the small one stops at three times its size
    rows = [(i, "a", 1000) for i in range(50)] + [(100, "b", 10), (101, "c", 20)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    want = check(got)
    assert want["b"] == 30 and want["c"] == 60 and {r.copies for r in got if r.source != "a"} == {3}


def test_edges(spark):
    rows = [(None, None, None), (None, None, "two words"), (1, "a", ""), (1, "a", " \t\n"), (1, "a", "x y z"), (1, "a", "x y z"), (2, "a", "w " * 50_000), (3, "b", None)]
    df = spark.createDataFrame([(*r, 1, 2, 3, "k", 4) for r in rows], "doc_id long, source string, text string, n int, part int, own int, key string, copies int")
    df = df.withColumn("size", mixing.words(F.col("text")))
    got = mixing.mix(df).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(a), len((t or "").split())) for a, _, t in rows)
    assert all(r.n == 1 and r.part == 2 and r.own == 3 and r.key == "k" for r in got)
    assert all(r.target == 0 and r.copies == 0 for r in got if r.source == "b")
    check(got)
    assert mixing.mix(df.limit(0)).count() == 0
    assert all(r.copies == 0 for r in mixing.mix(df.where("size = 0")).collect())


def test_native(spark):
    plan = QUERIES["op11_mixing"](spark, str(DATA / "sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
