import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from tessella.operators import graph
from tessella.operators import neighborhood as N
from tessella.operators import regions as G
from tessella.operators import runs as R

BLOCK = 8


def pixels(spark, m):
    ys, xs = np.nonzero(m)
    return spark.createDataFrame([(int(y), int(x)) for y, x in zip(ys, xs)], "y int, x int")


def image(spark, a):
    h, w, _ = a.shape
    return spark.createDataFrame([(y, x, *[int(v) for v in a[y, x]]) for y in range(h) for x in range(w)], "y int, x int, r int, g int, b int")


def mask(df, shape):
    m = np.zeros(shape, bool)
    for r in R.to_pixels(df).select("y", "x").collect():
        assert not m[r.y, r.x], "runs overlap"
        m[r.y, r.x] = True
    return m


SHAPES = {
    "random": np.random.default_rng(1).random((19, 27)) < 0.6,
    "sparse": np.random.default_rng(2).random((19, 27)) < 0.15,
    "empty": np.zeros((5, 9), bool),
    "full": np.ones((9, 20), bool),
    "u": np.array([[1, 0, 1], [1, 0, 1], [1, 1, 1]], bool),
    "diagonal": np.array([[1, 0], [0, 1]], bool),
    "ring": np.pad(np.pad(np.zeros((3, 3), bool), 1, constant_values=True), 2),
    "bay": np.array([[1, 1, 1, 1], [1, 0, 0, 0], [1, 1, 1, 1]], bool),
}


@pytest.mark.parametrize("name", SHAPES)
def test_morphology_labels_and_holes(spark, name):
    m = SHAPES[name]
    h, w = m.shape
    runs = R.from_pixels(pixels(spark, m), block=BLOCK)
    space = R.universe(spark, w, h, BLOCK)
    n = 2
    assert (mask(R.dilate(runs, n, w, h, block=BLOCK), m.shape) == brute.dilate(m, n)).all()
    assert (mask(R.erode(runs, n, space, w, h, block=BLOCK), m.shape) == brute.erode(m, n)).all()
    opened = brute.dilate(brute.erode(m, n), n)
    closed = brute.erode(brute.dilate(m, n), n)
    assert (mask(R.opening(runs, n, space, w, h, block=BLOCK), m.shape) == opened).all()
    assert (mask(R.closing(runs, n, space, w, h, block=BLOCK), m.shape) == closed).all()
    assert not (opened & ~m).any()
    assert (mask(R.complement(runs, space), m.shape) == ~m).all()
    assert (mask(G.fill_holes(runs, space, w, h, BLOCK), m.shape) == brute.fill_holes(m)).all()
    want = brute.components(m)
    reg = G.label(runs, block=BLOCK)
    got = np.full(m.shape, -1, np.int64)
    for r in R.to_pixels(reg.labelled()).collect():
        got[r.y, r.x] = r.label
    assert (got == want).all()
    sizes = {r.label: r.px for r in reg.sizes().collect()}
    assert sizes == {int(v): int((want == v).sum()) for v in np.unique(want[want >= 0])}


def test_maximal_runs_cross_blocks(spark):
    spans = spark.createDataFrame([(0, 3, 30), (0, 31, 40), (0, 44, 44), (1, 0, 7), (1, 8, 8)], "y long, x0 long, x1 long")
    got = sorted(map(tuple, R.maximal(R.merge(spans, block=BLOCK), block=BLOCK).select("y", "x0", "x1").collect()))
    assert got == [(0, 3, 40), (0, 44, 44), (1, 0, 8)]


@pytest.mark.parametrize("block", [4, 16, 64])
def test_labels_do_not_depend_on_blocks(spark, block):
    m = SHAPES["random"]
    reg = G.label(R.from_pixels(pixels(spark, m), block=block), block=block)
    want = brute.components(m)
    assert {r.label: r.px for r in reg.sizes().collect()} == {int(v): int((want == v).sum()) for v in np.unique(want[want >= 0])}


def test_components_with_hub_chain_and_hot_keys(spark):
    hub = [(0, i) for i in range(1, 400)]
    chain = [(1000 + i, 1001 + i) for i in range(60)]
    pairs = hub + chain + [(5000, 5001), (5001, 5002), (5002, 5000), (7, 7)]
    edges = spark.createDataFrame(pairs, "u long, v long")
    got = {r.id: r.root for r in graph.components(edges).collect()}
    want = {i: 0 for i in range(400)} | {1000 + i: 1000 for i in range(61)} | {5000 + i: 5000 for i in range(3)}
    assert got == want


def test_ranked_numbers_a_huge_group_in_order(spark):
    df = spark.range(5000).select((F.col("id") % 7 > 0).cast("int").alias("k"), (F.col("id") * 37 % 5000).alias("v"))
    got = graph.ranked(df, ["k"], ["v"]).collect()
    for k in (0, 1):
        rows = sorted((r.idx, r.v) for r in got if r.k == k)
        assert [i for i, _ in rows] == list(range(len(rows)))
        assert [v for _, v in rows] == sorted(v for _, v in rows)


@pytest.mark.parametrize("k", [3, 4, 7])
def test_box_sum_against_padded_array(spark, k):
    a = np.random.default_rng(3).integers(0, 256, (13, 21, 3))
    df = N.box_sum(image(spark, a), ["r"], k, 21, 13, own=["g"], block=8)
    before, after = k // 2, k - 1 - k // 2
    p = np.pad(a[..., 0], ((before, after), (before, after)), mode="symmetric")
    rows = df.collect()
    assert len(rows) == 13 * 21
    for r in rows:
        assert r.r == p[r.y : r.y + k, r.x : r.x + k].sum() and r.g == a[r.y, r.x, 1]


def test_gaussian_sum_against_padded_array(spark):
    a = np.random.default_rng(4).integers(0, 256, (15, 17, 3))
    wt = np.array(N.gaussian_weights(1.5))
    r0 = len(wt) // 2
    p = np.pad(a[..., 0], r0, mode="symmetric").astype(np.int64)
    for r in N.gaussian_sum(image(spark, a), "r", 1.5, 17, 15, block=8).collect():
        assert r.r == (p[r.y : r.y + 2 * r0 + 1, r.x : r.x + 2 * r0 + 1] * np.outer(wt, wt)).sum()


def test_median_by_counts_values(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k), int(v), int(255 - v), 7) for k, v in zip(rng.integers(0, 4, 301), rng.integers(0, 256, 301))]
    df = spark.createDataFrame(rows, "k int, r int, g int, b int")
    for r in G.median_by(df, ["k"], ["r", "g", "b"]).collect():
        own = [x for x in rows if x[0] == r.k]
        assert r.n == len(own) and r.r == np.median([x[1] for x in own]) and r.g == np.median([x[2] for x in own]) and r.b == 7


def test_labels_of_many_canvases_do_not_depend_on_blocks(spark):
    solid, rest = np.ones((20, 20), bool), SHAPES["random"]
    runs = [R.from_pixels(pixels(spark, m), block=8).withColumn("c", F.lit(i)) for i, m in enumerate((solid, rest))]
    reg = G.label(runs[0].unionByName(runs[1]), by=["c"], block=8)
    want = brute.components(rest)
    got = {(r.c, r.label): r.px for r in reg.sizes().collect()}
    assert got == {(0, 0): 400} | {(1, int(v)): int((want == v).sum()) for v in np.unique(want[want >= 0])}


@pytest.mark.parametrize("k", [9, 10])
def test_box_sum_of_canvases_smaller_than_the_box(spark, k):
    arrays = [np.random.default_rng(6).integers(0, 256, s) for s in ((3, 3, 3), (1, 2, 3), (4, 11, 3))]
    rows = [(i, a.shape[1], a.shape[0], y, x, int(a[y, x, 0])) for i, a in enumerate(arrays) for y in range(a.shape[0]) for x in range(a.shape[1])]
    df = spark.createDataFrame(rows, "c int, w int, h int, y int, x int, r int")
    got = N.box_sum(df, ["r"], k, F.col("w"), F.col("h"), by=["c", "w", "h"], block=4).collect()
    before, after = k // 2, k - 1 - k // 2
    padded = [np.pad(a[..., 0], ((before, after), (before, after)), mode="symmetric") for a in arrays]
    assert len(got) == len(rows) and all(r.r == padded[r.c][r.y : r.y + k, r.x : r.x + k].sum() for r in got)


def test_a_loop_leaves_only_its_last_table(spark):
    import pathlib

    from tessella.session import shared_dir

    root = pathlib.Path(shared_dir(spark).removeprefix("file:")) / "tessella"
    count = lambda: len([p for p in root.iterdir() if p.name.startswith(("edges", "star"))]) if root.exists() else 0
    before = count()
    graph.components(spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long")).count()
    assert count() == before + 1


@pytest.mark.parametrize("w, h", [(54, 38), (40, 50), (27, 19), (13, 9), (1, 1)])
def test_resized_mask_takes_the_pixel_under_each_centre(spark, w, h):
    m = SHAPES["random"]
    runs = R.from_pixels(pixels(spark, m), block=BLOCK)
    got = mask(R.merge(N.resize_runs(runs, 27, 19, w, h), block=BLOCK), (h, w))
    assert (got == m[(2 * np.arange(h) + 1) * 19 // (2 * h)][:, (2 * np.arange(w) + 1) * 27 // (2 * w)]).all()


def test_water_of_the_raw_capture_is_flooded_at_the_styled_size(spark):
    from tessella.plans import finishing as P

    raw = np.full((60, 60, 3), (40, 160, 40))
    raw[:, :40] = (90, 90, 90)  # smooth, grey and not blue
    styled = np.full((90, 120, 3), (200, 180, 160))
    out = P.flood_from_capture(image(spark, styled), 120, 90, image(spark, raw), 60, 60, block=32)
    flood = {(r.y, r.x): r.r for r in out.collect()}
    assert len(flood) == 90 * 120
    assert all(abs(flood[y, 30] - 104) < 5 for y in range(20, 70)) and all(flood[y, 110] == 200 for y in range(90))


def test_real_valued_medians_are_exact(spark):
    """Odd and even groups, ties, outliers of many magnitudes, one value, nulls and NaN; one group holds most rows."""
    import random
    import statistics

    from tessella.operators.regions import medians

    rnd = random.Random(2)
    draw = {
        "hot": lambda: rnd.gauss(100, 1e-6), "wide": lambda: 10 ** rnd.uniform(-200, 200), "ties": lambda: rnd.choice([1.25, 1.25, 7.5]), "one": lambda: 3.5, "two": lambda: rnd.random(),
    }
    rows = [(k, draw[k](), -draw[k]()) for k, n in (("hot", 3000), ("wide", 301), ("ties", 40), ("one", 5), ("two", 2)) for _ in range(n)]
    df = spark.createDataFrame(rows + [("hot", None, float("nan")), ("none", None, None)], "k string, v double, u double")
    got = {r.k: r for r in medians(df, ["k"], ["v", "u"]).collect()}
    assert set(got) == set(draw)
    for k in draw:
        v, u = [r[1] for r in rows if r[0] == k], [r[2] for r in rows if r[0] == k]
        assert (got[k].n, got[k].v, got[k].u) == (len(v), statistics.median(v), statistics.median(u))


def test_small_blocks_share_a_python_call(spark):
    """Several blocks of one group are labelled each by itself, and a group spans many small blocks."""
    import pandas as pd

    runs = pd.DataFrame([(7, 0, 0, 7, 0), (8, 0, 0, 7, 1), (7, 1, 8, 9, 0), (6, 1, 9, 9, 0)], columns=["y", "bx", "x0", "x1", "yb"])
    got = {(r.y, r.x0): r.local for r in G._label_block(runs).itertuples()}
    assert got == {(7, 0): (7 << G.SHIFT), (8, 0): (8 << G.SHIFT), (7, 8): (6 << G.SHIFT) + 9, (6, 9): (6 << G.SHIFT) + 9}
    assert R.span(8) == 128 and R.span(128) == 128 and R.span(1024) == 1024 and R.span(100) == 100
    m = np.random.default_rng(5).random((21, 300)) < 0.7
    grown = R.dilate(R.from_pixels(pixels(spark, m), block=BLOCK), 1, 300, 21, block=BLOCK)
    assert grown.where(f"x0 div {BLOCK} <> bx or x1 div {BLOCK} <> bx").count() == 0
    around = np.pad(m, 1)
    want = m | around[2:, 1:-1] | around[:-2, 1:-1] | around[1:-1, 2:] | around[1:-1, :-2]
    assert (mask(grown, m.shape) == want).all()
