"""File inventories."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD_BYTES = 200
#: The end of a ZIP archive without a comment; shorter marks of other kinds lie in it.
TAIL_BYTES = 22
#: What pyarrow calls the stores that Hadoop names so.
SCHEMES = {"hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Recursive listing (path, length, modificationTime) without reading contents.

    The listing leaves out empty files: an empty file counts as absent.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def list_rasters(spark: SparkSession, root: str, extensions: tuple[str, ...] = ("tif", "tiff")) -> DataFrame:
    return list_files(spark, root, "*.{" + ",".join(extensions) + "}")


def has_files(spark: SparkSession, root: str) -> bool:
    """Whether a folder exists and holds any entry, asked of Spark's own file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(path) and len(system.listStatus(path)) > 0


def _opened(path: str):
    """File system and place of a path as Hadoop writes it."""
    from pyarrow import fs

    # Folder names may hold spaces and percent signs, which are no part of a URI here.
    scheme, authority, place = re.match(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(/.*)", path).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), place
    if scheme not in SCHEMES:
        raise ValueError(f"no range reads of {scheme}: files; known are file, {', '.join(sorted(SCHEMES))}")
    system, base = fs.FileSystem.from_uri(f"{SCHEMES[scheme]}://{authority}/")
    return system, base.rstrip("/") + place


def with_ends(inventory: DataFrame, n: int = HEAD_BYTES, last: int = TAIL_BYTES) -> DataFrame:
    """Add `head`, the first n bytes of each file, and `tail`, the last ones; NULL for a file that is gone by now.

    Tasks read these ranges and nothing else, whatever a file's size and store; the driver sees no path. Anything but an
    absent file raises, and so does a store that ranges cannot be read from.
    """

    def ends(batches):
        import pandas as pd

        for pdf in batches:
            heads, tails = [], []
            for path in pdf["path"]:
                system, place = _opened(path)
                try:
                    with system.open_input_file(place) as f:
                        size = f.size()
                        heads.append(f.read_at(min(n, size), 0))
                        tails.append(f.read_at(min(last, size), max(0, size - last)))
                except FileNotFoundError:
                    heads.append(None)
                    tails.append(None)
            yield pdf.assign(head=pd.Series(heads, index=pdf.index, dtype=object), tail=pd.Series(tails, index=pdf.index, dtype=object))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inventory.schema) + ", head binary, tail binary"
    return inventory.mapInPandas(ends, schema)


def file_name(inventory: DataFrame) -> DataFrame:
    return inventory.withColumn("file_name", F.element_at(F.split("path", "/"), -1))
