"""Blocks of pixels and runs spread over many partitions, however few bytes they pack to."""

from pyspark.sql import functions as F

from tessella.operators import neighborhood as N
from tessella.operators import regions as G
from tessella.operators import runs as R
from tessella.session import ADVISORY


def test_small_blocks_keep_their_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        px = spark.range(256 * 256).select(F.floor(F.col("id") / 256).alias("y"), (F.col("id") % 256).alias("x"), F.lit(1).alias("v"))
        runs = R.from_pixels(px.where("x % 16 < 12"), block=16)
        assert R.dilate(runs, 1, 256, 256, block=16).rdd.getNumPartitions() == 16
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        deal = G.label(runs, block=16).runs
        assert deal.count() == runs.count() and deal.select("bx").distinct().count() == 16
        plan = R.dilate(runs, 1, 256, 256, block=16)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_NUM") == 1 and plan.split("FlatMapGroupsInPandas")[1].count("ENSURE_REQUIREMENTS") == 1  # one shuffle, as before, after that of the runs
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_partitions_of_pixels_stay_small(spark):
    old = spark.conf.get(ADVISORY)
    px = spark.range(64).select(F.floor(F.col("id") / 8).alias("y"), (F.col("id") % 8).alias("x"), F.lit(1).alias("v"))
    try:
        for make in (lambda: N.with_halo(px, ["v"], 8, 8, 1, 1), lambda: R.from_pixels(px)):
            for given, want in (("64MB", "4m"), ("134217728b", "4m"), ("64k", "64k")):
                spark.conf.set(ADVISORY, given)
                assert make().count() and spark.conf.get(ADVISORY) == want
    finally:
        spark.conf.set(ADVISORY, old)
