"""Reading landing files: everything arrives as text and is typed by try_cast later."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwatch.schemas import FEEDS, LABEL_COLUMNS
from lotwatch.session import small_splits

# Names of the columns that the row's own file has.
FILE_COLUMNS = "file_columns"
# When the row's own file was written.
SOURCE_TIME = "source_time"


def with_source(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("source_path"),
                     F.col("_metadata.file_modification_time").alias(SOURCE_TIME))


#: Bytes of a file that may be read to find its header.
HEADER_BYTES = 1 << 20
#: Schema of a listing: the content is never selected, so no file is opened for it.
LISTING = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def file_paths(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files of a folder, pattern or list, as Spark lists them."""
    listing = spark.read.format("binaryFile").schema(LISTING).load(path)
    return sorted(r["path"] for r in listing.select("path").collect())


def first_line(spark: SparkSession, path: str) -> str | None:
    """A file's first line from its first bytes; null for an empty file."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        bounded = jvm.org.apache.commons.io.input.BoundedInputStream(stream, HEADER_BYTES)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(bounded, "UTF-8")).readLine()
    finally:
        stream.close()


def headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The distinct headers of CSV files, and the files under each; empty files have none.

    Only the first bytes of each file are read, some files at a time; rows are not touched.
    """
    found: dict[tuple[str, ...], list[str]] = {}
    paths = file_paths(spark, path)
    with ThreadPoolExecutor(16) as pool:
        for file, line in zip(paths, pool.map(lambda p: first_line(spark, p), paths)):
            if line:
                found.setdefault(tuple(next(csv.reader([line]), ())), []).append(file)
    return found


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files with a header each; every column a string, so bad values reach the quarantine.

    Columns go by the header of the file they are in, whatever their order; what a file lacks
    is null. ``file_columns`` names what it has, for the check of required columns.
    """
    parts = []
    variants = headers(spark, path)
    for columns, files in sorted(variants.items()):
        ddl = ", ".join("`{}` STRING".format(c.replace("`", "``")) for c in columns)
        reader = spark.read.schema(ddl).option("header", True).option("enforceSchema", True)
        if isinstance(path, str) and not set("*?[{") & set(path):
            reader = reader.option("basePath", path)
        names = F.array(*[F.lit(c) for c in columns]).cast("array<string>")
        # One header for all: the folder is read as it is, without a list of its files.
        rows = reader.csv(path if len(variants) == 1 else sorted(files))
        parts.append(with_source(rows).withColumn(FILE_COLUMNS, names))
    if not parts:
        return spark.createDataFrame([], f"source_path STRING, {SOURCE_TIME} TIMESTAMP, {FILE_COLUMNS} ARRAY<STRING>")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_json(spark: SparkSession, path: str | list[str], columns: list[str],
              multi_line: bool = True) -> DataFrame:
    """A JSON array or object per file (or JSON lines), every column a string.

    A number kept as text is read from the file a second time, at its place, which costs far more
    bytes than it has; small splits hold the files of one task to a few.
    """
    small_splits(spark)
    ddl = ", ".join(f"`{c}` STRING" for c in columns)
    reader = spark.read.schema(ddl).option("multiLine", multi_line)
    return with_source(reader.json(path))


def file_stem(path: Column) -> Column:
    name = F.lower(F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1))
    return F.regexp_replace(name, r"\.(csv|xlsx|json)", "")


def route(path: Column) -> Column:
    """Landing feed of a file: the first registered stem contained in its name, else null."""
    stem = file_stem(path)
    return F.coalesce(*[F.when(stem.contains(f.stem), F.lit(f.stem)) for f in FEEDS])


def target_table(feed: Column) -> Column:
    return F.coalesce(*[F.when(feed == f.stem, F.lit(f.table)) for f in FEEDS])


def routed_files(files: DataFrame, path: str = "source_path") -> DataFrame:
    """Feed, table and status per file; files of no known feed are SKIPPED, not lost."""
    feed = route(F.col(path))
    return files.withColumn("feed", feed).withColumn("table_name", target_table(feed)).withColumn(
        "status", F.when(feed.isNull(), "SKIPPED").otherwise("ROUTED")
    )


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths under the landing folder; the content column is pruned, so no file is opened."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    supported = F.lower("path").rlike(r"\.(csv|json)$")
    return listing.filter(supported).select(F.col("path").alias("source_path"))


def new_files(listing: DataFrame, ingest_log: DataFrame) -> DataFrame:
    return listing.join(ingest_log.select("source_path"), "source_path", "left_anti")


def strip_labels(df: DataFrame, labels: tuple[str, ...] = LABEL_COLUMNS) -> DataFrame:
    return df.drop(*labels)
