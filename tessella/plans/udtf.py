"""Table functions."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


@udtf(returnType="kind string, qx int, qy int, quads int")
class PlanRow:
    """Calls of one tile row ``r`` of an ``nc`` x ``nr`` walk; join it laterally with the rows of the walks, so that
    a huge walk is planned row by row in parallel."""

    def eval(self, nc: int, nr: int, r: int):
        for c in range(nc):
            if r == 0 and c == 0:
                yield "seed", 0, 0, 4
            elif r == 0:
                yield "half_h", 2 * c, 0, 2
                yield "half_h", 2 * c + 1, 0, 2
            elif c == 0:
                yield "half_v", 0, 2 * r, 2
                yield "half_v", 0, 2 * r + 1, 2
            else:
                for i in range(4):
                    yield "br", 2 * c + i % 2, 2 * r + i // 2, 1


def register(spark: SparkSession) -> None:
    spark.udtf.register("plan_walk_row", PlanRow)
