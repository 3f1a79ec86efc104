"""Per-pixel colour expressions on the columns r, g, b (0..255)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

def rgb() -> tuple[Column, Column, Column]:
    return F.col("r"), F.col("g"), F.col("b")


RED = (237, 28, 36)  # fixed value: outline colour
GROUND = (150, 148, 143)  # fixed value: fallback ground colour


def grey3() -> Column:
    """Three times the mean grey, a whole number."""
    r, g, b = rgb()
    return r + g + b


def luma() -> Column:
    r, g, b = rgb()
    return F.lit(0.299).cast("double") * r + F.lit(0.587).cast("double") * g + F.lit(0.114).cast("double") * b


def clip_u8(c: Column) -> Column:
    """Clip to 0..255 and drop the fraction."""
    return F.floor(F.greatest(F.least(c.cast("double"), F.lit(255.0)), F.lit(0.0)))


def clip(c: Column) -> Column:
    """Clip to 0..255 and keep the fraction (and the name)."""
    return F.greatest(F.least(c, F.lit(255.0)), F.lit(0.0))


def _scaled(over: Column, factor: Column, cols=("r", "g", "b")) -> list[Column]:
    return [F.when(over, F.col(c) * factor).otherwise(F.col(c).cast("double")).alias(c) for c in cols]


def soften_whites(knee: float = 185, ceil: float = 222) -> list[Column]:
    """Above the knee, compress luma linearly so that 255 lands on ``ceil``; channels keep their ratios."""
    y = luma()
    slope = (ceil - knee) / (255.0 - knee)
    return _scaled(y > knee, (F.lit(float(knee)) + (y - float(knee)) * F.lit(slope)) / y)


def rolloff(top: float = 200, k: float = 0.40) -> list[Column]:
    """Mean-grey variant: brightness beyond ``top`` counts only ``k``-fold."""
    m = grey3() / F.lit(3.0)
    return _scaled(m > top, (F.lit(float(top)) + (m - float(top)) * F.lit(k)) / m)


def mute_green(keep: float = 0.62, darken: float = 0.92) -> list[Column]:
    r, g, b = rgb()
    green = (g - r > 18) & (g - b > 18)
    y = luma()
    return [
        F.when(green, (y * F.lit(1 - keep) + F.col(c) * F.lit(keep)) * F.lit(darken)).otherwise(F.col(c).cast("double")).alias(c)
        for c in ("r", "g", "b")
    ]


def is_blue() -> Column:
    r, g, b = rgb()
    return (b - r > 14) & (b - g > 8) & (b > 90)


def is_bluish() -> Column:
    r, g, b = rgb()
    return (b - r > 12) & (b - g > 4) & (b > 70) & (b < 250)


def is_vivid_blue() -> Column:
    r, g, b = rgb()
    return (b > r + 18) & (b > g) & (b > 115)


def is_walk_blue() -> Column:
    r, g, b = rgb()
    return (b > r + 6) & (b > g) & (b > 110)


def not_green() -> Column:
    r, g, b = rgb()
    return ~((g - r > 10) & (g - b > 10))


def is_neutral_bright(level: int = 140, spread: int = 24) -> Column:
    r, _, b = rgb()
    return (grey3() > 3 * level) & (F.abs(r - b) < spread)


def is_bright(level: int = 165) -> Column:
    return grey3() > 3 * level


def replace_alpha(target: list[Column], softness: float) -> Column:
    """Weight of a colour replacement: 1 on the target colour, 0 from ``softness`` on."""
    r, g, b = rgb()
    scale = max((softness / 255.0) * math.sqrt(3), 1e-5)
    d = F.lit(0.0)
    for c, t in zip((r, g, b), target):
        z = c / F.lit(255.0) - t.cast("double") / F.lit(255.0)
        d = d + z * z
    return F.greatest(F.least(F.lit(1.0) - F.sqrt(d) / F.lit(scale), F.lit(1.0)), F.lit(0.0))


def soft_color_replace(target: list[Column], new: tuple[int, int, int], softness: float) -> list[Column]:
    a = replace_alpha(target, softness)
    return [
        clip_u8((F.lit(n / 255.0) * a + (F.col(c) / F.lit(255.0)) * (F.lit(1.0) - a)) * F.lit(255.0)).alias(c)
        for c, n in zip("rgb", new)
    ]


def checkerboard(inside: Column, delta: int = 10) -> list[Column]:
    """Plus or minus ``delta`` in 2 x 2 cells inside the mask, clipped."""
    sign = ((F.floor(F.col("x") / 2) + F.floor(F.col("y") / 2)) % 2) * 2 - 1
    return [
        F.when(inside, F.greatest(F.least(F.col(c) + sign * delta, F.lit(255)), F.lit(0))).otherwise(F.col(c)).alias(c)
        for c in ("r", "g", "b")
    ]


def ripple(w: int, h: int, fy: float = 1.7, fx: float = 1.3, amp: float = 1.2, span: float = 6.28) -> Column:
    """Slow sine and cosine waves over the canvas."""
    yy = F.col("y") * F.lit(span / max(h - 1, 1))
    xx = F.col("x") * F.lit(span / max(w - 1, 1))
    return (F.sin(yy * F.lit(fy)) + F.cos(xx * F.lit(fx))) * F.lit(amp)


def flood(alpha: Column, color: tuple[int, int, int], wave: Column) -> list[Column]:
    return [
        clip_u8(F.col(c) * (F.lit(1.0) - alpha) + (F.lit(float(v)) + wave) * alpha).alias(c) for c, v in zip("rgb", color)
    ]


def tint_overlay(inside: Column, tint: tuple[int, int, int] = (0, 200, 255)) -> list[Column]:
    """45/55 mix with the tint inside the mask."""
    return [
        F.when(inside, F.floor((F.col(c) * 45 + v * 55) / 100)).otherwise(F.col(c)).alias(c) for c, v in zip("rgb", tint)
    ]


def on_outline(x0: Column, y0: Column, x1: Column, y1: Column, width: int = 2) -> Column:
    """Pixels of a box (upper ends exclusive) closer than ``width`` to its edge."""
    x, y = F.col("x"), F.col("y")
    inside = (x >= x0) & (x < x1) & (y >= y0) & (y < y1)
    return inside & (F.least(x - x0, x1 - 1 - x, y - y0, y1 - 1 - y) < width)


def fill_noise(channel: int) -> Column:
    """Whole number in -5..5 from a hash of place and channel."""
    x, y = F.col("x").cast("long"), F.col("y").cast("long")
    h = (x * 73856093) + (y * 19349663) + channel * 83492791
    h = h % 1000003
    return (h * (h % 1009 + 7919)) % 1000003 % 11 - 5


def edge_distance(w: Column, h: Column) -> Column:
    """Distance of (x, y) to the nearest edge of a w x h box; 0 on the edge."""
    x, y = F.col("x"), F.col("y")
    return F.least(x, y, w - 1 - x, h - 1 - y)


def ring_feather(d: Column, n: int) -> Column:
    """0..255 weight that rises over ``n`` pixels from the edge."""
    return F.when(d < n, F.floor((d + 1) * 255 / F.lit(n + 1))).otherwise(F.lit(255).cast("long"))


def edge_ramp(w: int, h: int, fade: int) -> Column:
    """Weight that rises linearly from the top, bottom and right edge (product); the left edge stays hard."""

    def up(d):
        return F.when(d < fade, d.cast("double") / F.lit(float(fade))).otherwise(F.lit(1.0))

    x, y = F.col("x"), F.col("y")
    return up(y) * up(F.lit(h - 1) - y) * up(F.lit(w - 1) - x)


def blend(over: str, base: str, alpha: Column) -> Column:
    return F.col(over) * alpha + F.col(base) * (F.lit(1.0) - alpha)
