"""Scene catalogues and job results from JSON dumps, read with explicit schemas."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsheaf import schemas
from cellsheaf.functions import instants, rings

# A polygon's coordinates nest one level less than a multipolygon's, so they are read as text first.
ITEM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("collection", T.StringType()),
        T.StructField("geometry", T.StructType(
            [T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]
        )),
        T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField("assets", T.MapType(T.StringType(), schemas.ASSET)),
        T.StructField("properties", T.StringType()),
    ]
)

PROPERTIES = T.StructType(
    [
        T.StructField("datetime", T.StringType()),
        T.StructField("eo:cloud_cover", T.DoubleType()),
        T.StructField("s2:mgrs_tile", T.StringType()),
        T.StructField("grid:code", T.StringType()),
    ]
)

PRODUCT_PAGE = T.StructType(
    [
        T.StructField("value", T.ArrayType(T.StructType(
            [
                T.StructField("Id", T.StringType()),
                T.StructField("Name", T.StringType()),
                T.StructField("ContentDate", T.StructType(
                    [T.StructField("Start", T.StringType()), T.StructField("End", T.StringType())]
                )),
                T.StructField("GeoFootprint", T.StructType(
                    [T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]
                )),
            ]
        )))
    ]
)

JOB_RESULT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("links", T.ArrayType(T.StructType(
            [T.StructField("rel", T.StringType()), T.StructField("href", T.StringType())]
        ))),
        T.StructField("assets", T.MapType(T.StringType(), schemas.ASSET)),
    ]
)


def rings_of(geom_type, coordinates):
    """Ring array of GeoJSON coordinates given as JSON text; NULL for other geometry types."""
    polygon = F.from_json(coordinates, "array<array<array<double>>>")
    multi = F.from_json(coordinates, "array<array<array<array<double>>>>")
    parts = F.when(geom_type == "Polygon", F.array(polygon)).when(geom_type == "MultiPolygon", multi)

    def ring(part, p):
        return F.transform(
            part,
            lambda pts, h: F.struct(
                p.cast("int").alias("part"),
                (h > 0).alias("hole"),
                F.transform(pts, lambda q: F.struct(F.get(q, F.lit(0)).alias("x"), F.get(q, F.lit(1)).alias("y"))).alias(
                    "pts"
                ),
            ),
        )

    return F.flatten(F.transform(parts, ring))


def read_scenes(spark: SparkSession, path: str) -> DataFrame:
    """Item catalogue dump, one JSON item per line."""
    p = F.from_json("properties", PROPERTIES)
    raw = spark.read.schema(ITEM).json(path).withColumn("_p", p)
    acquired = instants.parse_iso(F.col("_p.datetime"))
    b = [F.get("bbox", F.lit(i)) for i in range(4)]
    return raw.select(
        F.col("id").alias("scene_id"),
        "collection",
        F.col("id").alias("name"),
        acquired.alias("acq_start"),
        acquired.alias("acq_end"),
        F.col("_p")["eo:cloud_cover"].alias("cloud_cover"),
        F.col("_p")["s2:mgrs_tile"].alias("tile"),
        F.col("_p")["grid:code"].alias("grid_code"),
        F.col("geometry.type").alias("geom_type"),
        rings_of(F.col("geometry.type"), F.col("geometry.coordinates")).alias("rings"),
        F.struct(*[x.alias(n) for x, n in zip(b, schemas.BBOX.names)]).alias("bbox"),
        "assets",
        "properties",
    )


def read_products(spark: SparkSession, path: str, pretty: bool = False) -> DataFrame:
    """Pages of a product listing, each {"value": [...]}; paging is a union of pages and files.

    A page is one line, as a service sends it. `pretty` reads files that hold one page over
    several lines each; such a file cannot be split, but a page is small.
    """
    pages = spark.read.schema(PRODUCT_PAGE).option("multiLine", pretty).json(path)
    v = pages.select(F.explode("value").alias("p")).select("p.*")
    shape = rings_of(F.col("GeoFootprint.type"), F.col("GeoFootprint.coordinates"))
    return v.select(
        F.col("Id").alias("scene_id"),
        F.lit("SENTINEL-3").alias("collection"),
        F.col("Name").alias("name"),
        instants.parse_iso(F.col("ContentDate.Start")).alias("acq_start"),
        instants.parse_iso(F.col("ContentDate.End")).alias("acq_end"),
        F.col("GeoFootprint.type").alias("geom_type"),
        shape.alias("rings"),
        rings.bounds(shape).alias("bbox"),
        F.to_json(F.struct("Id", "Name", "ContentDate")).alias("properties"),
    )


def read_job_result(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Result documents as two tables: links(job_id, pos, rel, href) and assets(job_id, filename, href)."""
    docs = spark.read.schema(JOB_RESULT).json(path)
    links = docs.select(F.col("id").alias("job_id"), F.posexplode("links").alias("pos", "_l")).select(
        "job_id", "pos", "_l.rel", "_l.href"
    )
    assets = docs.select(F.col("id").alias("job_id"), F.explode("assets").alias("filename", "_a")).select(
        "job_id", "filename", "_a.href"
    )
    return links, assets
