"""Writing tiles, masks and pyramids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(tiles: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    """Per key the row with the highest ``seq`` (ties: highest remaining columns)."""
    rest = [c for c in tiles.columns if c not in key and c != seq]
    top = tiles.groupBy(*key).agg(F.max(F.struct(seq, *rest)).alias("top"))
    return top.select(*key, *[F.col(f"top.{c}").alias(c) for c in (seq, *rest)])


FOLDERS = 64  # of a table of tiles, whatever the number of regions


def write_tiles(tiles: DataFrame, path: str, part: str = "region", mode: str = "overwrite") -> None:
    """Partitioned Parquet; output keeps the input key. Regions are dealt over ``FOLDERS`` folders by a hash (``shard``) and sorted within files,
    so the number of files follows the size of the table and not that of the regions, and a reader of one region skips the other row groups.
    The rebalance step splits a folder that holds many tiles over several files."""
    dealt = tiles.withColumn("shard", F.pmod(F.xxhash64(part), F.lit(FOLDERS)).cast("int"))
    dealt.hint("rebalance", "shard").sortWithinPartitions("shard", part).write.mode(mode).partitionBy("shard").parquet(path)


def write_masks(runs: DataFrame, path: str, mode: str = "overwrite") -> None:
    runs.write.mode(mode).parquet(path)


def write_pyramid(tiles: DataFrame, descriptor: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``tiles`` partitioned by level, and the one-row descriptor next to it."""
    tiles.hint("rebalance", "level").write.mode(mode).partitionBy("level").parquet(f"{path}/tiles")
    descriptor.coalesce(1).write.mode(mode).json(f"{path}/descriptor")
