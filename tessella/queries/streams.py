"""Checked queries: streams over the given tables (K4-K7), drained with the available-now trigger."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella import fixtures as X
from tessella.operators import grid as G
from tessella.queries.registry import Tables, query
from tessella.queries.walks import PLAN
from tessella.streaming import arrivals as A


class Streams(Tables):
    """The given tables as file streams."""

    def __getattr__(self, name):
        schema = self.spark.read.parquet(f"{self.path}/{name}.parquet").schema
        return self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(self.path)


def streams(t):
    return Streams(t.spark, t.path)


@query("k4_watch_arrivals", "region:s col:l row:l n:l last:l", X.with_("tiles", body="SELECT 'r' || region AS region, col, row, count(*) AS n, max(seq) AS last FROM tiles GROUP BY ALL"))
def k4(t):
    got = A.run_available(G.parse_tiles(X.tile_files(streams(t))))
    return got.groupBy("region", "col", "row").agg(F.count("*").alias("n"), F.max("seq").alias("last"))


@query("k5_latest_stream", "call_id:l event_id:l secs:d", X.with_("edit_log", body="SELECT call_id, event_id, secs FROM (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY ts DESC, event_id DESC) AS rn FROM edit_log WHERE NOT failed) WHERE rn = 1"))
def k5(t):
    done = X.edit_log(streams(t)).where("NOT failed").select("call_id", "ts", "event_id", "secs")
    return A.latest_stream(done, ["call_id"], "ts")


@query(
    "k6_ready_calls", "walk:l call_id:l kind:s sources:l",
    X.with_(
        "quads", ctes=PLAN,
        body="SELECT d.walk, d.call_id, c.kind, count(*) AS sources FROM deps d JOIN quads q USING (walk, qx, qy) JOIN calls c ON c.walk = d.walk AND c.call_id = d.call_id GROUP BY ALL HAVING min(q.raw) > 6",
    ),
)
def k6(t):
    done = X.quads(streams(t)).where("raw > 6").join(X.walks(t), "walk")
    return A.run_available(A.ready_calls(done))


@query(
    "k7_throughput_stream", "start:s stop:s tiles:l cs:l",
    X.with_(
        "edit_log",
        body="SELECT CAST(s AS VARCHAR) AS start, CAST(s + INTERVAL 1 HOUR AS VARCHAR) AS stop, tiles, cs FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, count(*) AS tiles, sum(CAST(round(secs * 100) AS BIGINT)) AS cs FROM edit_log WHERE NOT failed GROUP BY 1)"
        " WHERE s + INTERVAL 1 HOUR <= (SELECT max(ts) FROM edit_log WHERE NOT failed) - INTERVAL 10 MINUTE",
    ),
)
def k7(t):
    got = A.run_available(A.throughput_stream(X.edit_log(streams(t))))
    return got.selectExpr(A.utc_text("start") + " start", A.utc_text("end") + " stop", "tiles", "cs")
