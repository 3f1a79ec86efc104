"""Ring assembly from loose arcs."""

import random

import pytest

from tessella.operators import vector as V


def rings(spark, arcs, **kw):
    df = spark.createDataFrame([(i, [(float(a), float(b)) for a, b in g]) for i, g in enumerate(arcs, 1)], "arc_id long, geometry array<struct<lat:double,lon:double>>")
    rows = V.chain_rings(df, **kw).collect()
    assert sorted(r.arc_id for r in rows) == list(range(1, len(arcs) + 1))
    out = {}
    for r in rows:
        out.setdefault((r.ring, r.points, r.closed), set()).add(r.arc_id)
    return {(k[0], k[2]): (k[1], v) for k, v in out.items()}


def test_two_triangles_with_one_common_corner(spark):
    got = rings(spark, [[(0, 0), (0, 1)], [(0, 1), (1, 0)], [(1, 0), (0, 0)], [(0, 0), (0, -1)], [(0, -1), (-1, 0)], [(-1, 0), (0, 0)]])
    assert got == {(1, True): (4, {1, 2, 3}), (4, True): (4, {4, 5, 6})}


def test_a_loose_chain_does_not_take_the_ring_with_it(spark):
    square = [[(0, 0), (0, 2)], [(0, 2), (2, 2)], [(2, 2), (2, 0)], [(2, 0), (0, 0)]]
    got = rings(spark, [[(5, 5), (4, 4)], [(4, 4), (2, 2)], *square])
    assert got == {(1, False): (3, {1, 2}), (3, True): (5, {3, 4, 5, 6})}


def test_closed_and_short_arcs(spark):
    got = rings(spark, [[(0, 0), (0, 1), (1, 1), (0, 0)], [(7, 7), (8, 8), (7, 7)], [(9, 9), (9, 8)]])
    assert got == {(1, True): (4, {1}), (2, False): (3, {2}), (3, False): (2, {3})}


@pytest.mark.parametrize("shift", [0.0, 0.49e-7, 0.5e-7, 0.99e-7])
def test_ends_meet_within_the_tolerance_anywhere(spark, shift):
    d = 0.02e-7
    got = rings(spark, [[(shift, 0), (0, 1)], [(0, 1 + d), (1, 0)], [(1, -d), (shift + d, d)]])
    assert got == {(1, True): (4, {1, 2, 3})}


def points(spark, arcs):
    """Rings as point cycles, and open chains."""
    df = spark.createDataFrame([(i, [(float(a), float(b)) for a, b in g]) for i, g in arcs.items()], "arc_id long, geometry array<struct<lat:double,lon:double>>")
    out = {}
    for r in V.ring_points(df, *V.assemble(df)).collect():
        out.setdefault((r.ring, r.closed), {})[r.seq] = (r.lat, r.lon)
    for (_, closed), p in out.items():
        assert sorted(p) == list(range(len(p))) and (not closed or p[0] == p[len(p) - 1])
    return sorted((closed, [p[i] for i in range(len(p))]) for (_, closed), p in out.items())


def square(a, b, size):
    return [(a, b), (a, b + size), (a + size, b + size), (a + size, b), (a, b)]


NESTED = [(0, 0), (1, 2), (2, 2), (2, 1), (0, 0)]  # inside square(0, 0, 4), sharing one corner


def area(p):
    return sum(a[1] * b[0] - b[1] * a[0] for a, b in zip(p, p[1:]))


def canonical(ring):
    """From the smallest point, counterclockwise, closed."""
    ring = ring[:-1] if ring[0] == ring[-1] else ring
    i = ring.index(min(ring))
    ring = ring[i:] + ring[:i] + [ring[i]]
    return ring if area(ring) > 0 else ring[::-1]


def traced(cells):
    """Serial half-edge tracer over the borders of grid cells: water stays on the left, and a walk that comes back to a point closes there."""
    darts = {}
    for y, x in cells:
        for a, b, beyond in (((y, x), (y, x + 1), (y - 1, x)), ((y, x + 1), (y + 1, x + 1), (y, x + 1)), ((y + 1, x + 1), (y + 1, x), (y + 1, x)), ((y + 1, x), (y, x), (y, x - 1))):
            if beyond not in cells:
                darts[a, b] = (y, x)
    rings, left = [], set(darts)
    while left:
        at = min(left)
        walk = []
        while at in left:
            left.discard(at)
            walk.append(at[0])
            if at[1] in walk:
                i = walk.index(at[1])
                rings.append(canonical(walk[i:] + [at[1]]))
                del walk[i:]
            ahead = [d for d in darts if d[0] == at[1]]
            at = next((d for d in ahead if darts[d] == darts[at]), ahead[0]) if len(ahead) > 1 else ahead[0]
    return sorted((True, r) for r in rings)


def border(cells):
    for y, x in cells:
        for a, b, beyond in (((y, x), (y, x + 1), (y - 1, x)), ((y, x + 1), (y + 1, x + 1), (y, x + 1)), ((y + 1, x), (y + 1, x + 1), (y + 1, x)), ((y, x), (y + 1, x), (y, x - 1))):
            if beyond not in cells:
                yield a, b


def test_points_of_rings_that_touch_nest_and_hang(spark):
    """Several maps side by side in one run: nested rings with a common corner, in three numberings of their arcs; borders of random cells with a hanging
    chain, against the serial tracer; one ring of many arcs with a long tail."""
    rnd = random.Random(4)
    arcs, want, free = {}, [], rnd.sample(range(1, 5000), 3000)

    def add(lat, pieces, rings, loose=()):
        move = lambda p: [(float(a + lat), float(b)) for a, b in p]
        for piece in pieces:
            arcs[free.pop()] = move(piece)
        want.extend((True, canonical(move(r))) for r in rings)
        want.extend((False, move(p)) for p in loose)

    outer = square(0, 0, 4)
    for k in range(3):
        pieces = [outer[:3], outer[2:][::-1], NESTED[:3], NESTED[2:]]
        rnd.shuffle(pieces)
        add(100 + 10 * k, pieces, [outer, NESTED])
    for k in range(4):
        cells = {(y, x) for y in range(7) for x in range(7) if rnd.random() < 0.55}
        pieces = [list(e) if rnd.random() < 0.5 else list(e)[::-1] for e in border(cells)]
        corner = min(min(p) for p in pieces)
        add(200 + 20 * k, [*pieces, [(-3, -3), (-2, -2)], [(-2, -2), corner]], [r for _, r in traced(cells)], [[(-3, -3), (-2, -2), corner]])
    n = 200
    ring = [(i, 0) for i in range(n)] + [(n - 0.5, 1)]
    tail = [(0, -i) for i in range(31)]
    add(1000, [[ring[i], ring[(i + 1) % len(ring)]] for i in range(len(ring))] + [[tail[i + 1], tail[i]] for i in range(30)], [ring])
    got = points(spark, arcs)
    assert (False, [(1000.0, float(-i)) for i in range(30, -1, -1)]) in got
    got.remove((False, [(1000.0, float(-i)) for i in range(30, -1, -1)]))
    assert got == sorted(want)
