"""SQL texts of the mask operators for the checking engine, written on pixels and independent of the Spark side."""

from __future__ import annotations


def offsets(n: int) -> str:
    return (
        f"(SELECT a.i AS dy, b.i AS dx FROM range(-{n}, {n + 1}) AS a(i), range(-{n}, {n + 1}) AS b(i)"
        f" WHERE abs(a.i) + abs(b.i) <= {n})"
    )


def dilate(name: str, src: str, n: int) -> str:
    return f"""{name} AS (SELECT DISTINCT m.y + dy AS y, m.x + dx AS x FROM {src} m, {offsets(n)} o, size
  WHERE m.y + dy BETWEEN 0 AND h - 1 AND m.x + dx BETWEEN 0 AND w - 1),
"""


def erode(name: str, src: str, n: int) -> str:
    return f"""{name} AS (SELECT m.y + dy AS y, m.x + dx AS x FROM {src} m, {offsets(n)} o
  GROUP BY 1, 2 HAVING count(*) = {2 * n * (n + 1) + 1}),
"""


def opening(name: str, src: str, n: int) -> str:
    return erode(name + "_e", src, n) + dilate(name, name + "_e", n)


def closing(name: str, src: str, n: int) -> str:
    return dilate(name + "_d", src, n) + erode(name, name + "_d", n)


def minus(name: str, a: str, b: str) -> str:
    return f"{name} AS (SELECT y, x FROM {a} EXCEPT SELECT y, x FROM {b}),\n"


def both(name: str, a: str, b: str) -> str:
    return f"{name} AS (SELECT y, x FROM {a} INTERSECT SELECT y, x FROM {b}),\n"


def either(name: str, a: str, b: str) -> str:
    return f"{name} AS (SELECT y, x FROM {a} UNION SELECT y, x FROM {b}),\n"


def canvas() -> str:
    return "canvas AS (SELECT a.i AS y, b.i AS x FROM size, range(h) AS a(i), range(w) AS b(i)),\n"


def runs(name: str, src: str, by: str = "") -> str:
    k = by + ", " if by else ""
    return f"""{name} AS (SELECT {k}y, min(x) AS x0, max(x) AS x1 FROM (
    SELECT {k}y, x, x - row_number() OVER (PARTITION BY {k}y ORDER BY x) AS isl FROM {src}) GROUP BY {k}y, isl),
"""


def label(name: str, src: str, by: str = "") -> str:
    """Runs with the id of their component: the smallest run id that reaches them."""
    k = by + ", " if by else ""
    same = "".join(f" AND a.{c.strip()} = b.{c.strip()}" for c in by.split(",")) if by else ""
    cols = "".join(f"a.{c.strip()}, " for c in by.split(",")) if by else ""
    walk = "".join(f"r.{c.strip()}, " for c in by.split(",")) if by else ""
    on = "".join(f" AND r.{c.strip()} = e.{c.strip()}" for c in by.split(",")) if by else ""
    return (
        runs(name + "_r0", src, by)
        + f"""{name}_r AS (SELECT *, y * 2147483648 + x0 AS id FROM {name}_r0),
{name}_h AS (SELECT {cols}a.id AS a, b.id AS b FROM {name}_r a JOIN {name}_r b
  ON b.y = a.y + 1 AND a.x0 <= b.x1 AND b.x0 <= a.x1{same}),
{name}_e AS (SELECT * FROM {name}_h UNION ALL SELECT {k}b AS a, a AS b FROM {name}_h),
{name}_w({k}root, id) AS (SELECT {k}id, id FROM {name}_r
  UNION SELECT {walk}r.root, e.b FROM {name}_w r JOIN {name}_e e ON r.id = e.a{on} WHERE e.b > r.root),
{name}_l AS (SELECT {k}id, min(root) AS label FROM {name}_w GROUP BY {k}id),
{name} AS (SELECT {k}y, x0, x1, label FROM {name}_r JOIN {name}_l USING ({k}id)),
"""
    )


def pixels(name: str, src: str, cols: str = "") -> str:
    c = cols + ", " if cols else ""
    return f"{name} AS (SELECT {c}y, unnest(range(x0, x1 + 1)) AS x FROM {src}),\n"


def mirrored(name: str, src: str, values: str, r: int) -> str:
    """Pixel values with ``r`` mirrored pixels beyond every border."""
    ax = f"SELECT i AS v, CASE WHEN i < 0 THEN -1 - i WHEN i >= {{s}} THEN 2 * {{s}} - 1 - i ELSE i END AS o FROM size, range(-{r}, {{s}} + {r}) AS t(i)"
    return f"""{name} AS (SELECT ay.v AS y, ax.v AS x, {values} FROM ({ax.format(s='h')}) ay, ({ax.format(s='w')}) ax, {src} p
  WHERE p.y = ay.o AND p.x = ax.o),
"""


def box(name: str, src: str, k: int, values: dict[str, str]) -> str:
    """Sum of each value expression over the k x k box, by two passes of joins."""
    r = k // 2
    cols = ", ".join(f"{e} AS {n}" for n, e in values.items())
    sums = ", ".join(f"sum({n}) AS {n}" for n in values)
    return (
        mirrored(name + "_m", src, cols, r)
        + f"""{name}_x AS (SELECT y, x + d AS x, {sums} FROM {name}_m, range(-{k - 1 - r}, {r + 1}) AS t(d) GROUP BY 1, 2),
{name}_y AS (SELECT y + d AS y, x, {sums} FROM {name}_x, range(-{k - 1 - r}, {r + 1}) AS t(d) GROUP BY 1, 2),
{name} AS (SELECT s.* FROM {name}_y s, size WHERE y BETWEEN 0 AND h - 1 AND x BETWEEN 0 AND w - 1),
"""
    )


def blur(name: str, src: str, weights: list[int], value: str) -> str:
    """Kernel-weighted sum of one value expression."""
    r = len(weights) // 2
    kern = ", ".join(f"({d - r}, {c})" for d, c in enumerate(weights))
    return (
        mirrored(name + "_m", src, f"{value} AS v", r)
        + f"""{name}_k(d, c) AS (VALUES {kern}),
{name}_x AS (SELECT y, x + d AS x, sum(v * c) AS v FROM {name}_m, {name}_k GROUP BY 1, 2),
{name}_y AS (SELECT y + d AS y, x, sum(v * c) AS v FROM {name}_x, {name}_k GROUP BY 1, 2),
{name} AS (SELECT s.* FROM {name}_y s, size WHERE y BETWEEN 0 AND h - 1 AND x BETWEEN 0 AND w - 1),
"""
    )
