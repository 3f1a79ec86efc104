"""Connected components of large graphs, and joins that keep hot keys apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessella.session import discard, save

HOT_PARTS = 1000  # a hot key holds more than 1/1000 of the rows, so there are fewer than 1000 of them


def lookup(rows: DataFrame, key: str, table: DataFrame, n: int) -> DataFrame:
    """Left join of ``n`` rows with a table unique on ``key``; rows of hot keys stay where they are, whatever their number."""
    hot = rows.groupBy(key).count().where(F.col("count") * HOT_PARTS > n).select(key)
    few = F.broadcast(hot.join(table, key, "left"))  # fewer than HOT_PARTS rows by the filter above
    rest = rows.join(F.broadcast(hot), key, "left_anti").join(table, key, "left")
    return rows.join(few, key).unionByName(rest)


def ranked(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "idx", total: str | None = None) -> DataFrame:
    """Number the rows of each ``by`` from 0 in the given order (which must be total); with ``total`` also the running
    sum ``upto`` of that column. Rows are sorted by range partitions, each partition numbers its own part and
    adds what the partitions before it hold, so one huge ``by`` still spreads over all tasks. The range partitions are a
    written table; once the result is saved elsewhere, ``discard`` of the result deletes it."""
    by, order = list(by), list(order)
    value = F.col(total) if total else F.lit(0)
    p = save(df.repartitionByRange(*by, *order).withColumn("pid", F.spark_partition_id()), "ranked")
    parts = p.groupBy(*by, "pid").agg(F.count("*").alias("n"), F.sum(value).alias("s"))
    w = W.partitionBy(*by).orderBy("pid").rowsBetween(W.unboundedPreceding, -1)  # one row per range partition and ``by``
    parts = parts.select(*by, "pid", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias("before_" + c) for c in ("n", "s")])
    own = W.partitionBy(*by, "pid").orderBy(*order)
    r = p.select("*", F.row_number().over(own).alias("own"), F.sum(value).over(own).alias("own_s")).join(parts, [*by, "pid"])
    upto = [(F.col("own_s") + F.col("before_s")).alias("upto")] if total else []
    out = r.select(*df.columns, (F.col("own") - 1 + F.col("before_n")).alias(name), *upto)
    out.saved_path = p.saved_path
    return out


def _open(edges: DataFrame) -> tuple[int, int]:
    """Number of edges, and of vertices that keep them from being stars: those above one vertex and below another, or below two."""
    roles = edges.select(F.col("u").alias("x"), F.lit(1).alias("below")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("below")))
    roles = roles.groupBy("x").agg(F.sum("below").alias("below"), F.min("below").alias("least"))
    mixed = (F.col("below") > 1) | (F.col("below") > 0) & (F.col("least") == 0)
    found = roles.agg(F.sum("below"), F.count_if(mixed)).first()
    return found[0] or 0, found[1]


def components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph ``(u, v)`` of longs: one row ``(id, root)`` per vertex, where the
    root is the smallest id. Alternating large-star and small-star steps until only stars are left; only pairs of ids are ever moved."""
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = save(e, "edges")
    n, left = _open(e)
    while left:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up = e.select(F.col("v").alias("u"), F.col("u").alias("child"))
        star = lookup(up, "u", low, n).select(F.col("child").alias("u"), F.col("m").alias("v")).distinct()
        star = save(star, "star")
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        near = lookup(star, "u", low, star.count())
        links = F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        nxt = near.select(F.explode(links).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        nxt = save(nxt, "edges")
        discard(star)
        discard(e)
        e = nxt
        n, left = _open(e)
    child = e.select(F.col("u").alias("id"), F.col("v").alias("root"))
    root = e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return child.unionByName(root)
