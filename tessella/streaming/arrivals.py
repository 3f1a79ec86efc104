"""Streams of tiles and edit results: arrivals, latest version, throughput, ready calls."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from tessella.operators import grid, monitor
from tessella.plans import walk
from tessella.session import new_path
from tessella.sources import sinks

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

FILE = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
        StructField("content", BinaryType()),
    ]
)


def watch_tiles(spark: SparkSession, folder: str, pattern: str = "tile_*.png") -> DataFrame:
    """Tile files of a folder as they appear, with col and row."""
    files = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", pattern).load(folder)
    return grid.parse_tiles(files)


def run_available(stream: DataFrame, path: str | None = None, mode: str = "append") -> DataFrame:
    """Take in all that is there now, append it to a Parquet sink and return the sink's table. Run again with the
    same ``path``, only what is new is processed."""
    spark = stream.sparkSession
    path = path or new_path(spark, "stream")
    q = (
        stream.writeStream.format("parquet").option("path", f"{path}/data").option("checkpointLocation", f"{path}/checkpoint")
        .outputMode(mode).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def latest_stream(stream: DataFrame, key: Sequence[str], seq: str, path: str | None = None) -> DataFrame:
    """Latest version per key of all that is there now. Each micro-batch leaves its own winners under its batch
    number (so a repeated batch replaces itself); reading picks the winner among batches."""
    spark = stream.sparkSession
    path = path or new_path(spark, "latest")

    def merge(df: DataFrame, batch: int) -> None:
        sinks.latest(df, key, seq).write.mode("overwrite").parquet(f"{path}/data/batch={batch}")

    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    schema = stream.select(*key, seq, *[c for c in stream.columns if c not in (*key, seq)]).schema
    return sinks.latest(spark.read.schema(schema).parquet(f"{path}/data"), key, seq)


def throughput_stream(log: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Finished tiles per tumbling window, emitted once when the window is closed. Watermarks need instants: a
    column without time zone is read as UTC, whatever the zone of the session."""
    done = log.where("NOT failed")
    if dict(log.dtypes)["ts"] == "timestamp_ntz":
        done = done.withColumn("ts", F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {EPOCH}, ts))"))
    return monitor.throughput_windows(done.withWatermark("ts", late), width)


def utc_text(col: str) -> str:
    """SQL text for an instant as UTC wall-clock text."""
    return f"cast(timestampadd(MICROSECOND, unix_micros({col}), {EPOCH}) as string)"


CALLS = 256  # calls that share one state
NEEDS = {"half_h": {"tl", "bl"}, "half_v": {"tl", "tr"}, "br": {"tl", "tr", "bl"}}


def ready_calls(finished: DataFrame, walks: DataFrame | None = None) -> DataFrame:
    """Calls whose sources are all finished, from a stream of finished quadrants ``(walk, nc, nr, qx, qy)``. With a stream of new
    ``walks`` also their first calls, which need no source.

    State is kept for ``CALLS`` calls of a walk at a time, however large the walk: one mask of slots each. Repeated events change
    nothing and a call is emitted once. State stays as long as the query runs: start it anew for a new set of walks."""
    used = finished.selectExpr("walk", f"explode({walk.dependents_sql()}) u").selectExpr("walk", "u.call_id", "u.kind", "u.wave", "u.slot")
    bit = {"tl": 1, "tr": 2, "bl": 4}
    needs = {k: sum(bit[s] for s in v) for k, v in NEEDS.items()}
    counts = {k: len(v) for k, v in NEEDS.items()}

    def collect(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = dict(zip(state.get[0], state.get[1])) if state.exists else {}
        seen, calls = dict(before), {}
        for pdf in batches:
            for call, kind, wave, slot in zip(pdf["call_id"].tolist(), pdf["kind"], pdf["wave"].tolist(), pdf["slot"]):
                seen[call] = seen.get(call, 0) | bit[slot]
                calls[call] = (kind, wave)
        state.update((list(seen), list(seen.values())))
        full = lambda masks, call, kind: masks.get(call, 0) & needs[kind] == needs[kind]
        ready = [(key[0], c, k, w, counts[k]) for c, (k, w) in calls.items() if full(seen, c, k) and not full(before, c, k)]
        if ready:
            yield pd.DataFrame(ready, columns=["walk", "call_id", "kind", "wave", "sources"])

    out = f"walk {dict(finished.dtypes)['walk']}, call_id bigint, kind string, wave int, sources int"
    some = used.withColumn("some", F.expr(f"call_id div {CALLS}")).groupBy("walk", "some")
    ready = some.applyInPandasWithState(collect, out, "calls array<bigint>, seen array<int>", "append", GroupStateTimeout.NoTimeout)
    if walks is None:
        return ready
    return ready.unionByName(walks.selectExpr("walk", "0L call_id", "'seed' kind", "0 wave", "0 sources"))
