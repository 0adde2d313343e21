"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lotwatch", master: str | None = None,
                  input_bytes: int | None = None, **conf: str) -> SparkSession:
    """Session with the library's defaults; ``input_bytes`` sizes the shuffles for the data,
    at about 128 MB a partition (AQE merges what turns out smaller)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if input_bytes:
        partitions = max(1, -(-input_bytes // (128 * 1024 * 1024)))
        defaults["spark.sql.shuffle.partitions"] = str(partitions)
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Bytes of a file that one task reads. Order lines take some fifteen bytes each on disk and a few
#: hundred as rows of a sort or an aggregate, so a split of Spark's 128 MB would not fit a task.
SPLIT_BYTES = 16 << 20


@contextmanager
def split_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """What runs inside reads files in splits of ``size``; the session's own comes back afterwards."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", size.lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def _at_most(spark: SparkSession, name: str, size: int) -> None:
    if _bytes(spark.conf.get(name)) > size:
        spark.conf.set(name, str(size))


def small_splits(spark: SparkSession) -> None:
    """Keep the session's splits at ``SPLIT_BYTES``, so that a task's rows don't grow with a table;
    smaller ones stay as they are."""
    _at_most(spark, "spark.sql.files.maxPartitionBytes", SPLIT_BYTES)


#: Bytes of a table's files for each partition of a shuffle, before AQE merges what is small.
TABLE_BYTES = 4 << 20


def small_shuffles(spark: SparkSession, path: str) -> None:
    """Let batch shuffles have a partition for every ``TABLE_BYTES`` of a table, and AQE merge them
    up to ``SPLIT_BYTES``, so that neither a task's sort nor its aggregate grows with the table and
    spills. More or smaller partitions stay as they are, streams keep ``spark.sql.shuffle.partitions``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = spark.conf.get(name, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if -(-size // TABLE_BYTES) > int(now):
        spark.conf.set(name, str(-(-size // TABLE_BYTES)))
    _at_most(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", SPLIT_BYTES)


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for local[*] test sessions."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    if sc.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="lotwatch-")
    return _LOCAL_ROOTS[sc.applicationId]


def run_folder(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables in the shared folder."""
    return f"{shared_root(spark)}/run-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_run(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; to be called when its results are stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _TABLES.clear()


#: How tables are compressed: a third smaller than Spark's default at much the same speed.
COMPRESSION = "zstd"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint that outlives lost executors."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    The table is computed once for all its consumers and survives lost executors, and the
    optimizer sees its true size: it is broadcast only below the session's
    spark.sql.autoBroadcastJoinThreshold and sort-merged (with skew splitting) above it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written once to the shared folder for what runs inside, and removed afterwards. A
    cache of the same rows goes to the executors' disks several times as large once memory is full."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        df.write.parquet(path, compression=COMPRESSION)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_TABLES: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, scope: str, name: str, write) -> str:
    """Folder that ``write(path)`` fills once per application."""
    key = (spark.sparkContext.applicationId, scope, f"folder {name}")
    if key not in _TABLES:
        path = scratch_path(spark, name)
        write(path)
        _TABLES[key] = path
    return _TABLES[key]


def stored(spark: SparkSession, scope: str, name: str, build) -> DataFrame:
    """Write ``build()`` once per application to the shared folder and read it back."""
    key = (spark.sparkContext.applicationId, scope, name)
    if key not in _TABLES:
        path = scratch_path(spark, name)
        build().write.parquet(path, compression=COMPRESSION)
        _TABLES[key] = path
    return spark.read.parquet(_TABLES[key])
