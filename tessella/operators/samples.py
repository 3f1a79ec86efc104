"""Training samples: pairing by stem, variants, dropout, buckets and comparison of runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import text as T


def _by_stem(lists: dict[str, DataFrame]) -> DataFrame:
    """One row per stem with one struct per list, null where the list lacks it. The tagged lists are grouped once,
    without joins, so repeated stems (the same file again) neither multiply nor pile up."""
    empty = {k: df.select(F.struct(*[c for c in df.columns if c != "stem"])).schema[0].dataType for k, df in lists.items()}
    tagged = None
    for tag, df in lists.items():
        own = F.struct(*[c for c in df.columns if c != "stem"])
        one = df.select("stem", *[(own if k == tag else F.lit(None).cast(empty[k])).alias(k) for k in lists])
        tagged = one if tagged is None else tagged.unionByName(one)
    return tagged.groupBy("stem").agg(*[F.max(k).alias(k) for k in lists])


def pair_samples(controls: DataFrame, targets: DataFrame, captions: DataFrame) -> DataFrame:
    """Complete samples ``(stem, control, target, caption)``, each a struct of the list's columns."""
    s = _by_stem({"control": controls, "target": targets, "caption": captions})
    return s.where("control IS NOT NULL AND target IS NOT NULL AND caption IS NOT NULL")


def pairing_report(controls: DataFrame, targets: DataFrame, captions: DataFrame) -> DataFrame:
    """One row per stem with what it has (1 or 0 each)."""
    s = _by_stem({k: df.select("stem", F.lit(1).alias("n")) for k, df in (("control", controls), ("target", targets), ("caption", captions))})
    return s.select("stem", *[F.col(k).isNotNull().cast("int").alias("has_" + k) for k in ("control", "target", "caption")])


def sample_variant(samples: DataFrame) -> DataFrame:
    """Tile, number and kind from names ``tile_C_R_NN_kind``."""
    part = lambda i: F.regexp_extract("stem", T.SAMPLE_NAME, i)
    return samples.where(F.col("stem").rlike(T.SAMPLE_NAME)).select(
        "*", part(1).cast("int").alias("col"), part(2).cast("int").alias("row"), part(3).cast("int").alias("no"), part(4).alias("kind")
    )


def preferred_sample(variants: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per key the first ``full`` sample, else the first one."""
    rank = F.struct((F.col("kind") != "full").cast("int").alias("k"), F.col("no"), F.col("stem"))
    return variants.groupBy(*key).agg(F.min(rank).alias("m"), F.count("*").alias("n")).select(
        *key, F.col("m.stem").alias("stem"), (F.col("m.k") == 0).alias("is_full"), "n"
    )


def caption_dropout(samples: DataFrame, rate: float, key: str) -> DataFrame:
    """Empty the caption of a share of the samples, chosen by a hash of the whole-number key."""
    # key * 2654435761 modulo 2^32, by halves so that no product leaves a long
    low, high = F.col(key).bitwiseAND(65535), F.shiftright(key, 16).bitwiseAND(65535)
    h = (low * 2654435761 + high * (2654435761 * 65536 % 4294967296) + 40503) % 4294967296 % 10000
    return samples.withColumn("caption", F.when(h < int(rate * 10000), F.lit("")).otherwise(F.col("caption")))


def resolution_buckets(samples: DataFrame, sizes: Sequence[int]) -> DataFrame:
    return samples.withColumn("resolution", F.explode(F.array(*[F.lit(s) for s in sizes])))


def infill_template(raw: DataFrame, finished: DataFrame, box: tuple[int, int, int, int]) -> DataFrame:
    """Training pairs for infilling: the control shows the finished tile with raw content inside an outlined
    box, the target is the finished tile. Both inputs hold tile pixels ``(col, row, y, x, r, g, b)``."""
    from tessella.functions import color as C

    x0, y0, x1, y1 = (F.lit(v) for v in box)
    inside = (F.col("x") >= x0) & (F.col("x") < x1) & (F.col("y") >= y0) & (F.col("y") < y1)
    key = ["col", "row", "y", "x"]
    j = finished.join(raw.where(inside).select(*key, *[F.col(c).alias("w_" + c) for c in "rgb"]), key, "left")
    edge = C.on_outline(x0, y0, x1, y1)
    return j.select(
        *key,
        *[F.when(edge, v).otherwise(F.coalesce("w_" + c, c)).alias("c_" + c) for c, v in zip("rgb", C.RED)],
        *[F.col(c).alias("t_" + c) for c in "rgb"],
    )


def compare_runs(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Mean absolute channel difference of two runs per tile; tiles that only one run has are reported with their
    pixel counts. Pixels are paired by one grouping of the two tagged tables instead of a full outer join."""
    key = list(key)
    sign = a.select(*key, "y", "x", *"rgb", F.lit(1).alias("s")).unionByName(b.select(*key, "y", "x", *"rgb", F.lit(-1).alias("s")))
    px = sign.groupBy(*key, "y", "x").agg(
        *[F.abs(F.sum(F.col(c) * F.col("s"))).alias(c) for c in "rgb"],
        F.max((F.col("s") > 0).cast("int")).alias("in_a"),
        F.max((F.col("s") < 0).cast("int")).alias("in_b"),
    )
    pair = F.col("in_a") * F.col("in_b")
    t = px.groupBy(*key).agg(
        F.sum("in_a").alias("n_a"), F.sum("in_b").alias("n_b"), F.sum(pair).alias("n"),
        F.sum((F.col("r") + F.col("g") + F.col("b")) * pair).alias("diff"),
    )
    return t.select(*key, "n_a", "n_b", F.when(F.col("n") > 0, F.round(F.col("diff") / (F.col("n") * 3.0), 4)).alias("mad"))
