"""Schemas of the input files."""

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])

MEMBER = T.StructType([T.StructField("role", T.StringType()), T.StructField("geometry", T.ArrayType(POINT))])

ELEMENT = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.ArrayType(POINT)),
        T.StructField("members", T.ArrayType(MEMBER)),
    ]
)

MAP_EXTRACT = T.StructType([T.StructField("elements", T.ArrayType(ELEMENT))])

MANIFEST = T.StructType([T.StructField("grid", T.IntegerType())])

CALIBRATION = T.StructType(
    [
        T.StructField("A", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("center", T.ArrayType(T.DoubleType())),
        T.StructField("mLat", T.DoubleType()),
        T.StructField("mLng", T.DoubleType()),
        T.StructField("col0", T.DoubleType()),
        T.StructField("row0", T.DoubleType()),
    ]
)

IMAGE = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("nChannels", T.IntegerType()),
        T.StructField("mode", T.IntegerType()),
        T.StructField("data", T.BinaryType()),
    ]
)
