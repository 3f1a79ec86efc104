"""The personal-data model comes from the examples of every text."""

from collections import Counter

import numpy as np

from tessella.llm import pii


def plain_boost(rows, labels, rounds, depth=3, rate=0.2, bins=32):
    x, y = np.asarray(rows, float), np.asarray(labels, float)
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    z = np.full(n, np.log((y.sum() + 1) / (n - y.sum() + 1)))

    def grow(mine, left):
        g, h = (y - p)[mine], (p * (1 - p) + 1e-6)[mine]
        if not left:
            step[mine] = rate * g.sum() / (h.sum() + 1)
            return
        best = (1e-3, None)
        for j in range(d):
            for c in cuts[j]:
                low = x[mine, j] <= c
                gl, hl = g[low].sum(), h[low].sum()
                gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - g.sum() ** 2 / (h.sum() + 1)
                best = max(best, (gain, (j, c)), key=lambda b: b[0])
        low = x[mine, best[1][0]] <= best[1][1] if best[1] else np.full(len(mine), True)
        grow(mine[low], left - 1)
        grow(mine[~low], left - 1)

    for _ in range(rounds):
        p, step = 1 / (1 + np.exp(-z)), np.zeros(n)
        grow(np.arange(n), depth)
        z += step
    return 1 / (1 + np.exp(-z))


def test_every_text_gives_its_examples(spark):
    """More texts than one sample held, with personal data in few of them and some of these twice."""
    hits = [f"mail a{i}@b{i}.example.com or call +1 555 010 {1000 + i} from 10.0.{i}.7, card 4111 1111 1111 111{i % 10}" for i in range(30)]
    rows = [(f"plain words {i}",) for i in range(30_000)] + [(t,) for t in hits + hits[:7]] + [(None,), ("",)]
    got = pii.labelled(spark.createDataFrame(rows, "text string").repartition(5)).collect()
    want = Counter((y, k, tuple(map(int, x))) for t in hits for y, k, x in pii.examples(t))
    assert sum((Counter({(r.y, r.kind, tuple(r.x)): r.n}) for r in got), Counter()) == want
    assert 0 < sum(r.n for r in got if r.test) < sum(want.values()) / 2


def test_boost_adds_up_to_the_plain_one(spark):
    r = np.random.default_rng(4)
    x = np.stack([r.integers(0, 2, 400), r.integers(0, 9, 400), r.integers(0, 200, 400)], 1)
    y = (x[:, 0] + x[:, 1] + r.integers(0, 4, 400) > 7).astype(int)
    counts = Counter((int(b), tuple(a.tolist())) for a, b in zip(x, y))
    rows = [(b, list(a), n) for (b, a), n in counts.items()]
    want = plain_boost(x, y, 5)
    for parts in (1, 7):
        m = pii.boost(spark.createDataFrame(rows, "y int, x array<int>, n long").repartition(parts), rounds=5)
        assert np.allclose(m.probability(x), want, atol=1e-4)


def test_one_label_gives_no_model(spark):
    docs = spark.createDataFrame([("nothing here",), (None,)], "text string")
    assert pii.fit(docs).trees == [] and pii.boost(spark.createDataFrame([(1, [1], 2)], "y int, x array<int>, n long")).trees == []


def test_a_level_of_a_tree_is_a_task_a_core(spark):
    """However many files the examples came in, a job over them has no shuffle and no more tasks than cores."""
    r = np.random.default_rng(5)
    rows = [(int(a + b > 9), [int(a), int(b)], 1) for a, b in r.integers(0, 12, (600, 2))]
    many = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "1k"}
    old = {k: spark.conf.get(k) for k in many}
    sc, tasks = spark.sparkContext, []
    try:
        for k, v in many.items():
            spark.conf.set(k, v)
        for rounds in (1, 3):
            sc.setJobGroup(f"rounds{rounds}", "")
            assert pii.boost(spark.createDataFrame(rows, "y int, x array<int>, n long").repartition(60), rounds=rounds).trees
            jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(f"rounds{rounds}")]
            tasks.append(sum(sc.statusTracker().getStageInfo(s).numTasks for j in jobs for s in j.stageIds))
    finally:
        sc._jsc.clearJobGroup()
        for k, v in old.items():
            spark.conf.set(k, v)
    assert 0 < tasks[1] - tasks[0] <= 2 * 3 * sc.defaultParallelism
