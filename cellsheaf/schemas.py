"""Table layouts. Pixels live in a long cell table; NULL is the only encoding of "no data"."""

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])

RING = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("hole", T.BooleanType()),
        T.StructField("pts", T.ArrayType(POINT)),
    ]
)

AOI = T.StructType(
    [
        T.StructField("aoi_id", T.StringType()),
        T.StructField("geom_type", T.StringType()),
        T.StructField("rings", T.ArrayType(RING)),
    ]
)

BBOX = T.StructType([T.StructField(n, T.DoubleType()) for n in ("minx", "miny", "maxx", "maxy")])

ASSET = T.StructType([T.StructField("href", T.StringType())])

SCENE = T.StructType(
    [
        T.StructField("scene_id", T.StringType()),
        T.StructField("collection", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("acq_start", T.TimestampNTZType()),
        T.StructField("acq_end", T.TimestampNTZType()),
        T.StructField("cloud_cover", T.DoubleType()),
        T.StructField("tile", T.StringType()),
        T.StructField("grid_code", T.StringType()),
        T.StructField("geom_type", T.StringType()),
        T.StructField("rings", T.ArrayType(RING)),
        T.StructField("bbox", BBOX),
        T.StructField("assets", T.MapType(T.StringType(), ASSET)),
        T.StructField("properties", T.StringType()),
    ]
)

GRID = T.StructType(
    [
        T.StructField("raster_id", T.StringType()),
        T.StructField("epsg", T.IntegerType()),
        T.StructField("x0", T.DoubleType()),
        T.StructField("y0", T.DoubleType()),
        T.StructField("dx", T.DoubleType()),
        T.StructField("dy", T.DoubleType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("nodata", T.DoubleType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("data_source", T.StringType()),
        T.StructField("variable_name", T.StringType()),
        T.StructField("acquisition_time", T.TimestampNTZType()),
        T.StructField("polygon", T.StringType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField("path", T.StringType()),
        T.StructField("download_successful", T.BooleanType()),
        T.StructField("error", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)
