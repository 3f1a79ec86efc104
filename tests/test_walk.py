import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from tessella.functions import color as C
from tessella.plans import editor as E
from tessella.plans import river as V
from tessella.plans import walk as K
from tessella.queries.jobs import soften_in_context
from tessella.queries.walks import linear_editor
from test_masks import image


@pytest.mark.parametrize("nc,nr", [(1, 1), (1, 4), (3, 2), (6, 6)])
def test_plan_covers_every_quadrant_once(spark, nc, nr):
    calls = K.plan_calls(spark.createDataFrame([(0, nc, nr)], "walk int, nc int, nr int")).collect()
    assert len(calls) == 1 + 2 * (nc - 1) + 2 * (nr - 1) + 4 * (nc - 1) * (nr - 1)
    assert sorted(c.call_id for c in calls) == list(range(len(calls)))
    made = [(q.qx, q.qy) for c in calls for q in c.prod]
    assert sorted(made) == [(x, y) for x in range(2 * nc) for y in range(2 * nr)]
    wave = {(q.qx, q.qy): c.wave for c in calls for q in c.prod}
    for c in calls:
        needed = [wave[q.qx, q.qy] for q in c.deps]
        assert all(c.wave - 2 <= v < c.wave for v in needed)
        assert c.wave == (max(needed) + 1 if needed else 0)
    assert max(wave.values()) + 1 == 2 * (nc + nr) - 3


def test_dependents_invert_deps(spark):
    walks = spark.createDataFrame([(0, 4, 3)], "walk int, nc int, nr int")
    want = {(q.qx, q.qy, c.call_id, c.kind, c.wave) for c in K.plan_calls(walks).collect() for q in c.deps}
    quads = walks.selectExpr("*", "explode(sequence(0, 2*nc-1)) qx").selectExpr("*", "explode(sequence(0, 2*nr-1)) qy")
    got = quads.selectExpr("qx", "qy", f"inline({K.dependents_sql()})").collect()
    assert {(r.qx, r.qy, r.call_id, r.kind, r.wave) for r in got} == want and len(got) == len(want)


def test_walk_against_a_serial_run(spark):
    nc, nr = 3, 2
    rng = np.random.default_rng(7)
    raw = {(x, y): int(rng.integers(1, 50)) for x in range(2 * nc) for y in range(2 * nr)}
    g = {}
    for y in range(2 * nr):
        for x in range(2 * nc):
            if x < 2 and y < 2:
                g[x, y] = raw[x, y]
            elif y < 2:
                g[x, y] = raw[x, y] + g[x - 1, y]
            elif x < 2:
                g[x, y] = raw[x, y] + g[x, y - 1]
    for y in range(2, 2 * nr):
        for x in range(2, 2 * nc):
            g[x, y] = raw[x, y] + g[x - 1, y] + g[x, y - 1] - g[x - 1, y - 1]
    df = spark.createDataFrame([(5, nc, nr, x, y, v) for (x, y), v in raw.items()], "walk int, nc int, nr int, qx int, qy int, payload long")
    got = {(r.qx, r.qy): r.payload for r in K.run_walk(df, E.ColumnEditor(linear_editor)).collect()}
    assert got == g


def test_walk_with_a_python_editor_on_bytes(spark):
    """A Python editor sees bytes of the whole window and returns the changed window columns."""

    class Join:
        def apply(self, df):
            return df.withColumn("br", F.when(F.col("kind") == "br", F.concat("tl", "br")).otherwise(F.col("br")))

    df = spark.createDataFrame([(1, 2, 2, x, y, bytes([x * 10 + y])) for x in range(4) for y in range(4)], "walk int, nc int, nr int, qx int, qy int, payload binary")
    got = {(r.qx, r.qy): bytes(r.payload) for r in K.run_walk(df, Join()).collect()}
    assert got[2, 2] == bytes([11, 22]) and got[3, 3] == bytes([11, 22, 33]) and got[3, 0] == bytes([30])


@pytest.mark.parametrize("renumber", [2, 32])
def test_breadth_first_order(spark, renumber):
    rng = np.random.default_rng(11)
    cells = {r: sorted({(int(c), int(q)) for c, q in zip(rng.integers(0, 8, 34), rng.integers(0, 8, 34))}) for r in (3, 4)}
    df = spark.createDataFrame([(r, c, q) for r, v in cells.items() for c, q in v], "region int, col int, row int")
    rows = V.bfs_order(df, "region", renumber).collect()
    for r in cells:
        got = [(x.col, x.row) for x in sorted((x for x in rows if x.region == r), key=lambda x: x.idx)]
        assert got == brute.breadth_first(cells[r])


def serial_edits(canvas, boxes, win, feather, raw=None, fill=None):
    """The boxes one after another on the canvas as it then is."""
    a = canvas.astype(np.int64).copy()
    h, w, _ = a.shape
    for k, x0, y0, x1, y1 in sorted(boxes):
        wx = max(0, min(w - win, (x0 + x1) // 2 - win // 2))
        wy = max(0, min(h - win, (y0 + y1) // 2 - win // 2))
        shown = a[wy : wy + win, wx : wx + win].copy()
        bx, by, ex, ey = x0 - wx, y0 - wy, x1 - wx, y1 - wy
        if raw is not None:
            shown[by:ey, bx:ex] = raw[y0:y1, x0:x1]
        if fill is not None:
            shown[by:ey, bx:ex] = fill[k]
        for i in range(2):
            shown[[by + i, ey - 1 - i], bx:ex] = C.RED
            shown[by:ey, [bx + i, ex - 1 - i]] = C.RED
        out = (shown + np.floor(shown.reshape(-1, 3).mean(0)).astype(np.int64)) // 2
        for y in range(y0, y1):
            for x in range(x0, x1):
                d = min(x - x0, y - y0, x1 - 1 - x, y1 - 1 - y)
                al = 255 * (d + 1) // (feather + 1) if d < feather else 255
                a[y, x] = (out[y - wy, x - wx] * al + a[y, x] * (255 - al)) // 255
    return a


def to_array(df, shape):
    a = np.full(shape, -1, np.int64)
    for r in df.collect():
        a[r.y, r.x] = (r.r, r.g, r.b)
    return a


def test_river_walk_sees_earlier_results(spark):
    rng = np.random.default_rng(12)
    canvas, raw = rng.integers(0, 256, (32, 40, 3)), rng.integers(0, 256, (32, 40, 3))
    tiles = [(0, 0), (1, 0), (1, 1), (2, 1), (2, 2), (3, 3), (4, 3), (9, 9)]
    order = spark.createDataFrame([(c, r, i) for i, (c, r) in enumerate(tiles)], "col int, row int, idx int")
    got = V.river_walk(image(spark, canvas), image(spark, raw), order, E.ColumnEditor(soften_in_context), 8, 2, 40, 32)
    boxes = [(i, c * 8, r * 8, c * 8 + 8, r * 8 + 8) for i, (c, r) in enumerate(tiles) if c < 5 and r < 4]
    assert (to_array(got, canvas.shape) == serial_edits(canvas, boxes, 16, 2, raw=raw)).all()


def test_infill_with_prefill(spark):
    rng = np.random.default_rng(13)
    canvas = rng.integers(0, 120, (30, 36, 3))
    boxes = [(1, 4, 4, 12, 10), (2, 8, 8, 15, 14), (5, 25, 20, 33, 28)]
    df = spark.createDataFrame(boxes, "box_id long, x0 long, y0 long, x1 long, y1 long")
    img = image(spark, canvas)
    fill = {r.box_id: (r.fr, r.fg, r.fb) for r in V.prefill_color(img, df, ring=3).collect()}
    for k, x0, y0, x1, y1 in boxes:
        px = [canvas[y, x] for y in range(max(0, y0 - 3), min(30, y1 + 3)) for x in range(max(0, x0 - 3), min(36, x1 + 3)) if not (x0 <= x < x1 and y0 <= y < y1)]
        px = np.array([p for p in px if not (p[2] - p[0] > 14 and p[2] - p[1] > 8 and p[2] > 90)])
        want = tuple(int(np.median(px[:, i])) for i in range(3)) if len(px) > 50 else C.GROUND
        assert fill[k] == want
    got = V.infill_regions(img, df, E.ColumnEditor(soften_in_context), 16, 2, 36, 30, prefill=True, ring=3)
    assert (to_array(got, canvas.shape) == serial_edits(canvas, boxes, 16, 2, fill=fill)).all()


def test_editor_keeps_failures_as_rows(spark):
    df = spark.createDataFrame([(i, bytes([i])) for i in range(6)], "id int, payload binary")

    def edit(row, model):
        v = row["payload"][0]
        if v == 2:
            raise ValueError("broken")
        return None if v == 4 else bytes([v + model])

    ed = E.PythonEditor(edit, load=lambda: 100)
    out = E.convert_tiles(df, ed, 2)
    got = {r.id: (r.status, r.payload and bytes(r.payload)) for r in out.collect()}
    assert got[2] == ("fail: broken", None) and got[4] == ("no image", None) and got[5] == ("ok", bytes([105]))
    kept = {r.id: bytes(r.payload) for r in E.or_keep(df, out, ["id"]).collect()}
    assert kept == {0: b"d", 1: b"e", 2: b"\x02", 3: b"g", 4: b"\x04", 5: b"i"}


def test_later_boxes_never_leak_into_earlier_windows(spark):
    """The window of box 2 shows box 3, which shows nothing itself: it still must not run first."""
    rng = np.random.default_rng(14)
    canvas = rng.integers(0, 256, (60, 60, 3))
    for boxes in ([(1, 20, 20, 24, 24), (2, 26, 20, 30, 24), (3, 35, 16, 47, 28)], [(i, int(x), int(y), int(x) + 3 + i % 9, int(y) + 2 + i % 7) for i, (x, y) in enumerate(rng.integers(0, 47, (14, 2)))]):
        df = spark.createDataFrame(boxes, "box_id long, x0 long, y0 long, x1 long, y1 long")
        got = V.infill_regions(image(spark, canvas), df, E.ColumnEditor(soften_in_context), 16, 2, 60, 60)
        assert (to_array(got, canvas.shape) == serial_edits(canvas, boxes, 16, 2)).all()
    with pytest.raises(ValueError, match="larger"):
        V.infill_regions(image(spark, canvas), spark.createDataFrame([(1, 0, 0, 20, 4)], "box_id long, x0 long, y0 long, x1 long, y1 long"), E.ColumnEditor(soften_in_context), 16, 2, 60, 60)


def test_window_editor_resizes_and_keeps_failures(spark):
    a = np.random.default_rng(15).integers(0, 256, (4, 6, 3))
    px = image(spark, a).crossJoin(spark.range(3).withColumnRenamed("id", "box_id"))

    def edit(row, model):
        if row["box_id"] == 1:
            return b"short"
        if row["box_id"] == 2:
            return bytes([1, 2, 3, 4, 5, 6]), 2, 1  # two pixels side by side
        assert (row["width"], row["height"], row["prompt"]) == (6, 4, "p") and row["seed"] >= 0
        return bytes(255 - v for v in row["payload"])

    got = E.WindowEditor(E.PythonEditor(edit, options=E.Options(prompt="p"))).apply(px).collect()
    for r in got:
        old = tuple(a[r.y, r.x])
        want = {0: tuple(255 - v for v in old), 1: old, 2: (3, 2, 1) if r.x < 3 else (6, 5, 4)}[r.box_id]
        assert (r.r, r.g, r.b) == want and r.status == {0: "ok", 1: "fail: wrong size", 2: "ok"}[r.box_id]
    assert len(got) == 72


def test_walk_stops_at_a_failed_call_and_goes_on(spark, tmp_path):
    quads = [(1, 2, 2, x, y, bytes([x, y, 7])) for x in range(4) for y in range(4)]
    df = spark.createDataFrame(quads, "walk int, nc int, nr int, qx int, qy int, payload binary")
    path, log = str(tmp_path / "walk"), tmp_path / "log"

    def edit(row, model):
        with log.open("a") as f:
            f.write(f"{row['call_id']}\n")
        if row["kind"] == "br" and not (tmp_path / "go").exists():
            raise ValueError("no model")
        return row["payload"]

    editor = E.QuadEditor(E.PythonEditor(edit), 1, 1)
    with pytest.raises(RuntimeError, match="no model"):
        K.run_walk(df, editor, path)
    (tmp_path / "go").touch()
    seen = log.read_text().count("\n")
    got = {(r.qx, r.qy): bytes(r.payload) for r in K.run_walk(df, editor, path).collect()}
    assert got == {(q[3], q[4]): q[5] for q in quads}
    calls = log.read_text().split()
    assert len(set(calls)) == 9 and calls.count(calls[0]) == 1 and len(calls) > seen  # the first wave ran once
    again = len(calls)
    K.run_walk(df, editor, path).count()
    assert len(log.read_text().split()) == again
    with pytest.raises(RuntimeError, match="missing quadrant"):
        K.run_walk(df.where("NOT (qx = 0 AND qy = 1)"), editor)


def test_tile_sets_of_far_cells_stay_apart(spark):
    df = spark.createDataFrame([(0, 0, 1 << 20), (0, 1, 0), (0, -1, -1), (0, -1, 0), (7, 0, 0)], "region int, col int, row int")
    got = {(r.region, r.col, r.row): r.comp for r in V.tile_components(df, "region").collect()}
    assert got[0, -1, -1] == got[0, -1, 0] and len(set(got.values())) == 4


def test_rounds_follow_blocks_not_links(spark, monkeypatch):
    """A chain of jobs in one block settles in two turns, however long; across blocks it costs a turn per change of block."""
    turns = []
    save = V.save
    monkeypatch.setattr(V, "save", lambda df, name="step": (turns.append(name), save(df, name))[1])
    jobs = spark.range(60).selectExpr("id box_id", "cast(id div 20 as string) block")
    waits = spark.range(1, 60).selectExpr("id box_id", "id - 1 on", "cast(id % 3 <> 0 as int) gap")
    got = {r.box_id: r.wave for r in V.rounds(jobs, waits).collect()}
    want = [0]
    for k in range(1, 60):
        want.append(want[-1] + (k % 3 != 0))
    assert got == dict(enumerate(want)) and len(turns) <= 1 + 4


def test_breadth_first_rounds_take_many_levels(spark, monkeypatch):
    saved = []
    save = V.save
    monkeypatch.setattr(V, "save", lambda df, name="step": (saved.append(name), save(df, name))[1])
    df = spark.range(70).selectExpr("1 region", "cast(id as int) col", "0 row")
    rows = {r.col: (r.level, r.idx) for r in V.bfs_order(df, "region").collect()}
    assert rows == {c: (c, c) for c in range(70)} and saved.count("front") == 3
