"""Registry of checked queries: one Spark callable, one output schema and (mostly) one SQL text each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK_TYPE = {"l": "bigint", "d": "double", "s": "string", "b": "boolean"}
SQL_TYPE = {"l": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN"}


class Tables:
    """The given parquet tables of one scale folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


@dataclass
class Query:
    fn: Callable[[Tables], DataFrame]
    cols: dict[str, str]
    sql: str | None

    def run(self, spark: SparkSession, path: str) -> DataFrame:
        df = self.fn(Tables(spark, path))
        return df.select(*[F.col(c).cast(SPARK_TYPE[t]).alias(c) for c, t in self.cols.items()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        out = ", ".join(f"CAST({c} AS {SQL_TYPE[t]}) AS {c}" for c, t in self.cols.items())
        return f"SELECT {out} FROM (\n{self.sql}\n) AS result"


QUERIES: dict[str, Query] = {}


def query(name: str, cols: str, sql: str | None = None):
    """Register ``fn``; ``cols`` lists the output as ``name:type`` with types l, d, s, b."""

    def deco(fn):
        QUERIES[name] = Query(fn, dict(c.split(":") for c in cols.split()), sql)
        return fn

    return deco
