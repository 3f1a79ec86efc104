"""Masks meet their pixels by a shuffle, however small the file of their runs is."""

from pyspark.sql import functions as F

from tessella.operators import runs as R
from tessella.plans import finishing as P
from tessella.session import save


def test_no_mask_goes_through_the_driver(spark):
    by = ["col", "row", "w", "h"]
    at = [(F.col("id") % 2).alias("col"), F.lit(0).alias("row"), F.lit(40).alias("w"), F.lit(30).alias("h")]
    at += [F.floor(F.col("id") / 80).alias("y"), (F.floor(F.col("id") / 2) % 40).alias("x")]
    px = spark.range(2 * 40 * 30).select(*at, *[F.lit(v).alias(c) for c, v in zip("rgb", (3, 100, 250))])
    mask = save(R.from_pixels(px.where("x BETWEEN 4 AND 33 AND y > 1"), by), "mask")
    out = P.augment_controls(px, mask, by)
    got = {(r.col, r.y, r.x): (r.r, r.g, r.b) for r in out.collect()}
    assert len(got) == 2400
    for (_, y, x), v in got.items():
        s = 10 if (x // 2 + y // 2) % 2 else -10
        assert v == ((max(3 + s, 0), 100 + s, min(250 + s, 255)) if 4 <= x <= 33 and y > 1 else (3, 100, 250))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
