"""Small helpers of the operators in this folder."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def worker_cached(slot: str, key, build: Callable):
    """``build()`` once per Python worker process and ``key``; a slot keeps its latest value (a model or a memo table)."""
    store = sys.modules.setdefault("_tessella_worker", types.ModuleType("_tessella_worker")).__dict__
    if slot not in store or store[slot][0] != key:
        store[slot] = (key, build())
    return store[slot][1]


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def small_batches(spark) -> None:
    """Texts are long: Arrow batches of at most ``BATCH_ROWS`` rows keep the buffers of an executor and its workers small.
    Sets the session's limit unless it is smaller already."""
    now = int(spark.conf.get(BATCH))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))


def add_columns(df: DataFrame, inputs: list[Column], outputs: str, fn: Callable[..., Iterator], batch_rows: int | None = None) -> DataFrame:
    """``df`` with the columns of the DDL text ``outputs`` added by one Arrow pass without a shuffle.

    ``fn`` gets one list per input column and returns one list per output column, batch by batch. Columns of ``df``
    that carry an output's name are replaced; all others pass through untouched, whatever they are called.
    """
    small_batches(df.sparkSession)
    new = T.StructType.fromDDL(outputs) if isinstance(outputs, str) else outputs
    keep = [f for f in df.schema.fields if f.name not in set(new.names)]
    schema = T.StructType([*keep, *new])
    n = len(keep)
    names = [f"c{i}" for i in range(n)] + [f"in{i}" for i in range(len(inputs))]
    plain = df.select(*[df[f"`{f.name}`"] for f in keep], *inputs).toDF(*names)

    def run(batches):
        target = None
        for whole in batches:
            for at in range(0, max(whole.num_rows, 1), batch_rows or max(whole.num_rows, 1)):
                b = whole.slice(at, batch_rows) if batch_rows else whole
                if not b.num_rows:
                    continue
                got = fn(*[b.column(n + i).to_pylist() for i in range(b.num_columns - n)])
                if target is None:
                    from pyspark.sql.pandas.types import to_arrow_schema

                    target = to_arrow_schema(new)
                cols = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, target.field(i).type) for i, x in enumerate(got)]
                yield pa.RecordBatch.from_arrays([*b.columns[:n], *cols], names=[f"c{i}" for i in range(n + len(new))])
        pa.default_memory_pool().release_unused()

    out = plain.mapInArrow(run, T.StructType([T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(schema.fields)]))
    return out.toDF(*schema.names)


def text_of(df: DataFrame, name: str) -> Column:
    """The text column by its exact name, null as empty text."""
    return F.coalesce(df[f"`{name}`"].cast("string"), F.lit(""))


def sha256(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)
