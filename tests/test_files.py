import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import grid as G
from tessella.operators import pyramid as P
from tessella.plans import walk as K
from tessella.sources import sinks
from tessella.sources import tiles as ST
from tessella.streaming import arrivals as A
from test_masks import image


def png(a) -> bytes:
    h, w, _ = a.shape
    raw = b"".join(b"\0" + a[y].astype(np.uint8).tobytes() for y in range(h))

    def part(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


def test_scan_and_decode_png_tiles(spark, tmp_path):
    rng = np.random.default_rng(21)
    tiles = {(0, 0): rng.integers(0, 256, (16, 16, 3)), (2, 1): rng.integers(0, 256, (3, 5, 3))}
    for (c, r), a in tiles.items():
        (tmp_path / f"tile_{c}_{r}.png").write_bytes(png(a))
    (tmp_path / "tile_x_1.png").write_bytes(b"no")
    (tmp_path / "other.txt").write_text("no")
    got = {(r.col, r.row) for r in ST.scan_tiles(spark, str(tmp_path)).collect()}
    assert got == set(tiles)
    px = ST.tiles_to_pixels(ST.read_images(spark, str(tmp_path))).collect()
    assert len(px) == 16 * 16 + 3 * 5
    for p in px:
        assert (p.r, p.g, p.b) == tuple(tiles[p.col, p.row][p.y, p.x])
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError):
        ST.scan_tiles(spark, str(tmp_path / "none"))


def test_json_side_files(spark, tmp_path):
    (tmp_path / "manifest.json").write_text(json.dumps({"grid": 7}))
    (tmp_path / "list.json").write_text(json.dumps([[1, 2], [1, 2], [3, 4]]))
    m = ST.parse_manifest(ST.read_text_documents(spark, str(tmp_path / "manifest.json")), []).first()
    assert m.grid == 7
    cells = ST.parse_tile_list(ST.read_text_documents(spark, str(tmp_path / "list.json"))).collect()
    assert sorted((c.col, c.row) for c in cells) == [(1, 2), (3, 4)]
    bad = spark.createDataFrame([("a", "{}"), ("b", '{"grid": -1}'), ("c", "not json")], "region string, doc string")
    ext = spark.createDataFrame([("a", 2, 3), ("b", 2, 3), ("c", 2, 3), ("d", 1, 1)], "region string, cols int, rows int")
    got = G.override_extent(ext, ST.parse_manifest(bad, ["region"]), ["region"]).collect()
    assert {(r.region, r.cols, r.rows) for r in got} == {("a", 2, 3), ("b", 2, 3), ("c", 2, 3), ("d", 1, 1)}


def test_member_without_role_is_dropped_and_empty_role_kept(spark):
    from tessella.operators import vector as V

    line = [{"lat": 0.0, "lon": 0.0}, {"lat": 1.0, "lon": 1.0}]
    doc = {"elements": [{"type": "relation", "id": 1, "members": [{"geometry": line}, {"role": "", "geometry": line}, {"role": "outer"}, {"role": "inner", "geometry": line}]}, {"type": "node", "id": 2}, {"type": "way", "id": 3, "geometry": line}]}
    lines = ST.parse_features(spark.createDataFrame([(json.dumps(doc),)], "doc string"))
    got = sorted((r.osm_id, r.member) for r in V.outer_lines(lines).collect())
    assert got == [(1, 1), (3, 0)]


def test_rings_of_many_arcs_and_open_chains(spark):
    from tessella.operators import vector as V

    def arc(i, pts):
        return (i, [{"lat": float(a), "lon": float(b)} for a, b in pts])

    n = 40
    circle = [(np.cos(2 * np.pi * i / n), np.sin(2 * np.pi * i / n)) for i in range(n)]
    arcs = [arc(i, [circle[i], circle[(i + 1) % n]][:: 1 if i % 2 else -1]) for i in range(n)]
    arcs += [arc(100, [(5, 5), (6, 6)]), arc(101, [(6, 6), (7, 5)])]  # open
    arcs += [arc(200, [(9, 9), (9, 10), (10, 10), (9, 9)])]  # closed on its own
    arcs += [arc(300, [(20, 20), (21, 21)]), arc(301, [(21, 21), (20, 20)])]  # closed, but three points only
    df = spark.createDataFrame(arcs, "arc_id long, geometry array<struct<lat double, lon double>>")
    got = {r.arc_id: (r.closed, r.points) for r in V.chain_rings(df).collect()}
    assert all(got[i] == (True, n + 1) for i in range(n))
    assert got[100] == got[101] == (False, 3) and got[200] == (True, 4) and got[300] == (False, 3)


def test_write_tiles_last_write_wins(spark, tmp_path):
    rows = [("a", 0, 0, 1, 10), ("a", 0, 0, 3, 30), ("a", 0, 0, 2, 20), ("b", 1, 1, 1, 5)]
    df = spark.createDataFrame(rows, "region string, col int, row int, seq int, v int")
    sinks.write_tiles(sinks.latest(df, ["region", "col", "row"], "seq"), str(tmp_path / "out"))
    got = {(r.region, r.seq, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("a", 3, 30), ("b", 1, 5)}


def test_write_tiles_of_many_regions(spark, tmp_path):
    """Folders don't grow with the regions, and their names come back as they are."""
    df = spark.range(600).selectExpr("lpad(cast(id div 2 as string), 4, '0') region", "cast(id % 2 as int) col", "0 row", "id seq")
    sinks.write_tiles(df, str(tmp_path / "out"))
    assert len([p for p in (tmp_path / "out").iterdir() if p.is_dir()]) <= sinks.FOLDERS
    got = {(r.region, r.col, r.seq) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(f"{i // 2:04d}", i % 2, i) for i in range(600)}


def test_ready_calls_share_state(spark, tmp_path):
    """One Python call serves many calls of a walk: the states are far fewer than the calls."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(400).selectExpr("1 walk", "10 nc", "10 nr", "cast(id % 20 as int) qx", "cast(id div 20 as int) qy").write.parquet(src)
    ready = A.run_available(A.ready_calls(spark.readStream.schema("walk int, nc int, nr int, qx int, qy int").parquet(src)), out)
    calls = K.plan_calls(spark.createDataFrame([(1, 10, 10)], "walk int, nc int, nr int")).where("size(deps) > 0").count()
    assert ready.count() == ready.select("call_id").distinct().count() == calls
    state = spark.read.format("statestore").load(f"{out}/checkpoint")
    assert state.count() == -(-(calls + 1) // A.CALLS)


def test_pyramid_counts(spark):
    total = P.pyramid_summary(P.pyramid_boxes(spark, 11776, 13312)).collect()
    assert {r.level: r.tiles for r in total}[None] == 3213 and len(total) == 16
    a = np.random.default_rng(22).integers(0, 256, (9, 21, 3))
    lv = P.pyramid_levels(image(spark, a), 21, 9).collect()
    for r in lv:
        s = 2 ** (5 - r.level)
        cell = a[r.y * s : r.y * s + s, r.x * s : r.x * s + s].reshape(-1, 3)
        assert (r.r, r.g, r.b) == tuple(int(v) for v in cell.sum(0) // len(cell))
    assert len(lv) == sum(-(-9 // 2**k) * -(-21 // 2**k) for k in range(6))


def test_stream_of_tiles_is_incremental(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "tile_0_0.png").write_bytes(b"a")
    stream = lambda: A.watch_tiles(spark, str(src)).select("col", "row", "length")
    assert A.run_available(stream(), out).count() == 1
    (src / "tile_1_2.png").write_bytes(b"bb")
    (src / "x.png").write_bytes(b"bb")
    got = A.run_available(stream(), out).collect()
    assert sorted((r.col, r.row, r.length) for r in got) == [(0, 0, 1), (1, 2, 2)]


def test_ready_calls_across_batches(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "walk int, nc int, nr int, qx int, qy int"

    def finish(*quads):
        spark.createDataFrame([(1, 2, 2, x, y) for x, y in quads], schema).write.mode("append").parquet(src)
        ready = A.run_available(A.ready_calls(spark.readStream.schema(schema).parquet(src)), out)
        return sorted(r.call_id for r in ready.collect())

    by_id = {c.call_id: c for c in K.plan_calls(spark.createDataFrame([(1, 2, 2)], "walk int, nc int, nr int")).collect()}
    assert finish((1, 0), (0, 1)) == []
    first = finish((1, 1), (1, 1), (1, 0))
    assert first == sorted(i for i, c in by_id.items() if c.deps and {(q.qx, q.qy) for q in c.deps} <= {(1, 0), (0, 1), (1, 1)})
    everything = finish(*[(x, y) for x in range(4) for y in range(4)])
    assert everything == sorted(i for i, c in by_id.items() if c.deps)


def test_latest_stream_over_batches(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k int, seq int, v string"
    spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], schema).write.mode("append").parquet(src)
    A.latest_stream(spark.readStream.schema(schema).parquet(src), ["k"], "seq", out)
    spark.createDataFrame([(1, 3, "c"), (2, 4, "d")], schema).write.mode("append").parquet(src)
    got = A.latest_stream(spark.readStream.schema(schema).parquet(src), ["k"], "seq", out).collect()
    assert {(r.k, r.seq, r.v) for r in got} == {(1, 3, "c"), (2, 5, "b")}


def test_windows_overlap_and_clip(spark):
    a = np.random.default_rng(23).integers(0, 256, (20, 20, 3))
    win = spark.createDataFrame([(1, 0, 0, 6, 6), (2, 3, 4, 15, 9), (3, 18, 18, 24, 24)], "k int, wx0 int, wy0 int, wx1 int, wy1 int")
    got = G.extract_window(image(spark, a), win, ["k"], block=8).collect()
    assert len(got) == 36 + 60 + 4
    off = {1: (0, 0), 2: (3, 4), 3: (18, 18)}
    assert all((r.r, r.g, r.b) == tuple(a[r.y + off[r.k][1], r.x + off[r.k][0]]) for r in got)


def test_stitch_with_nothing_missing_and_one_cell(spark):
    from tessella.operators import mosaic as M

    a = np.random.default_rng(24).integers(0, 256, (4, 4, 3))
    px = image(spark, a).select(F.lit(1).alias("col"), F.lit(0).alias("row"), "*")
    got = M.stitch(px, G.grid_extent(px), 4).collect()
    assert len(got) == 32
    assert all((r.r, r.g, r.b) == (M.HOLE if r.x < 4 else tuple(a[r.y, r.x - 4])) for r in got)
