"""Reading tables, mapping Arrow batches in bounded slices, written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwatch.session import COMPRESSION, scratch_path

#: Text bytes that a task works on at once; one longer text makes a slice of its own.
SLICE_BYTES = 2 << 20
#: Rows in an Arrow batch between the JVM and a Python worker.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end, and the n + 1 row offsets; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one slice stay near SLICE_BYTES."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(by)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(size):
            if i > start and total + n > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if start < len(size):
            yield batch.slice(start)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema,
               text: str = "text") -> DataFrame:
    """``fn`` over every slice of the rows; narrow, so a lost task is simply run again."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            out = fn(piece)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


#: Whether a query's shuffle files go when it ends, or when the driver next collects garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that are made and run inside go when these end."""
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


class Written:
    """A table written once to the shared folder; it outlives executors and cuts lineage. The
    shuffle files of the write go with its end, as nothing reads them again."""

    def __init__(self, df: DataFrame, name: str) -> None:
        self.spark, self.path = df.sparkSession, scratch_path(df.sparkSession, name)
        with cleaned(self.spark):
            df.write.parquet(self.path, compression=COMPRESSION)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Remove the files once no later job reads them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as make it differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Bits of a table of marks.
MARKS = 1 << 25


def marks(values: DataFrame) -> np.ndarray:
    """Bit table of the low bits of a column of well-mixed longs.

    It has at most MARKS bits whatever the input, so it can travel with a task. It tells which
    rows may be wanted: never misses one, and lets others through the more, the fuller it is.
    Exact joins follow.
    """
    name = values.columns[0]
    with cleaned(values.sparkSession):
        place = values.select(F.expr(f"cast({name} & {MARKS - 1} as int)").alias("place"))
        rows = place.select(F.expr("cast(place div 32 as int)").alias("word"), (F.col("place") % 32).alias("bit")).groupBy(
            "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow()
    table = np.zeros(MARKS // 32, np.uint32)
    table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return table


def marked(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    low = values & (MARKS - 1)
    return ((table[low // 32] >> (low % 32).astype(np.uint32)) & 1).astype(bool)


def apart(docs: DataFrame, key: str, keys: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``docs`` in two: rows whose key is not in ``keys``, and the rest, which holds all rows
    whose key is and perhaps a few others. Neither shuffles; only the rest needs exact joins."""
    table = marks(keys.select(F.xxhash64(F.col(keys.columns[0])).alias("mark")))
    mark = fresh_name(docs, "_mark")
    rows = docs.withColumn(mark, F.xxhash64(F.col(key)))

    def part(wanted: bool) -> DataFrame:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array(marked(table, batch.column(mark).to_numpy()) == wanted))

        return map_slices(rows, run, rows.schema, text).drop(mark)

    return part(False), part(True)
