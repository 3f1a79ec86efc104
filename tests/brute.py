"""Plain step-by-step versions of the operators on small arrays."""

from __future__ import annotations

import numpy as np


def step(m):
    """One step of the 4-neighbour cross; outside is false."""
    p = np.pad(m, 1)
    return p[1:-1, 1:-1] | p[:-2, 1:-1] | p[2:, 1:-1] | p[1:-1, :-2] | p[1:-1, 2:]


def dilate(m, n):
    for _ in range(n):
        m = step(m)
    return m


def erode(m, n):
    for _ in range(n):
        p = np.pad(m, 1)
        m = p[1:-1, 1:-1] & p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:]
    return m


def components(m):
    """Label of every pixel: y * 2**31 + x of the component's first pixel; -1 outside."""
    out = np.full(m.shape, -1, np.int64)
    for y, x in zip(*np.nonzero(m)):
        if out[y, x] >= 0:
            continue
        out[y, x] = lab = (int(y) << 31) + int(x)
        todo = [(y, x)]
        while todo:
            cy, cx = todo.pop()
            for ny, nx in ((cy + 1, cx), (cy - 1, cx), (cy, cx + 1), (cy, cx - 1)):
                if 0 <= ny < m.shape[0] and 0 <= nx < m.shape[1] and m[ny, nx] and out[ny, nx] < 0:
                    out[ny, nx] = lab
                    todo.append((ny, nx))
    return out


def fill_holes(m):
    bg = components(~m)
    border = set(bg[0]) | set(bg[-1]) | set(bg[:, 0]) | set(bg[:, -1])
    return m | ((bg >= 0) & ~np.isin(bg, list(border)))


def breadth_first(cells):
    """Level lists, one connected set after the other."""
    order, rest = [], sorted(cells)
    while rest:
        level, placed = [rest[0]], {rest[0]}
        while level:
            order += level
            found = []
            for c, r in level:
                for dc, dr in ((1, 0), (-1, 0), (0, 1), (0, -1)):
                    cell = (c + dc, r + dr)
                    if cell in rest and cell not in placed:
                        placed.add(cell)
                        found.append(cell)
            level = found
        rest = [c for c in rest if c not in placed]
    return order
