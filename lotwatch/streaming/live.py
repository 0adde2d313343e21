"""Structured Streaming forms of ingestion, dedup, the weekly trend and alerting."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from lotwatch.operators import detection
from lotwatch.params import DetectionParams
from lotwatch.plans.stages import RunParams, assess, split
from lotwatch.schemas import LandingFeed
from lotwatch.session import COMPRESSION, held
from lotwatch.sources import versions
from lotwatch.sources.landing import LISTING, read_csv
from lotwatch.sources.tables import with_lineage


# Workers get the state's class by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def landing_stream(spark: SparkSession, folder: str, glob: str = "*.csv", files_per_trigger: int | None = None) -> DataFrame:
    """Paths of new landing files; no file is opened, ``ingest`` reads each by its own header."""
    reader = spark.readStream.format("binaryFile").schema(LISTING).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder).select(F.col("_metadata.file_path").alias("source_path"))


def ingest(stream: DataFrame, feed: LandingFeed, folder: str, run_id: str, at: Column | str,
           params: RunParams, available_now: bool = True, interval: str = "15 minutes") -> StreamingQuery:
    """Ingest each landing file exactly once, by the checks of the batch stage.

    The file-source checkpoint remembers the files. Every micro-batch is a run of the keyed
    table of its own, so a key that a later file delivers again replaces the stored row, and a
    batch replayed after a failure leaves the same rows. Rejected rows and the log overwrite
    their own ``batch_id`` folder; the log lists files of a header alone too. Spark never lists
    files of no bytes.
    """

    def land(files: DataFrame, batch_id: int) -> None:
        spark = files.sparkSession
        paths = sorted(r["source_path"] for r in files.distinct().collect())
        if not paths:
            return
        with held(assess(read_csv(spark, [unquote(p) for p in paths]), feed, params), "assessed") as rows:
            out = split(rows, feed, run_id, at, paths)
            versions.merge(out.good, f"{folder}/{feed.table}", feed.key, f"{run_id}/{batch_id}", at)
            outputs = {
                "bad_records": with_lineage(out.bad, run_id, at, "quarantined_at"),
                "ingest_log": with_lineage(out.log, run_id, at, "ingested_at"),
            }
            for name, df in outputs.items():
                df.write.mode("overwrite").parquet(f"{folder}/{name}/batch_id={batch_id}", compression=COMPRESSION)

    writer = stream.writeStream.foreachBatch(land).option(
        "checkpointLocation", f"{folder}/_checkpoint")
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def deduplicated(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """First arrival of each key; state is dropped once the watermark has passed."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def weekly_trend(stream: DataFrame, time: str, delay: str, threshold: float) -> DataFrame:
    """Monday-to-Sunday defect rates per supplier; rows behind the watermark are dropped.

    Windows count from the epoch, a Thursday, so four days shift them to Mondays.
    """
    rate = F.col("defect_count") / F.greatest("units_inspected", F.lit(1))
    week = F.window(time, "7 days", startTime="4 days")
    return (
        stream.withWatermark(time, delay)
        .groupBy(week, "supplier_id")
        .agg(
            F.avg(rate).alias("weekly_defect_rate"),
            F.count(F.lit(1)).alias("inspections"),
            F.sum("units_inspected").alias("total_units_inspected"),
            F.sum("defect_count").alias("total_defects"),
        )
        .select(
            "supplier_id", F.to_date("window.start").alias("production_week"),
            "weekly_defect_rate", "inspections", "total_units_inspected", "total_defects",
            (F.col("weekly_defect_rate") >= threshold).alias("above_threshold"))
    )


class _LotMean(StatefulProcessor):
    """Number and sum of the rates that have arrived on each lot of a bucket since its last pause.

    A bucket's lots are taken together, as columns: lots are many and small, and a call, a state
    and a timer for each of them would cost far more than its few rows.
    """

    def __init__(self, lot: str, rate: str, time: str, order: Sequence[str], idle_ms: int, state: StructType, shown: Sequence[str]) -> None:
        self.lot, self.rate, self.time, self.order, self.idle_ms = lot, rate, time, list(order), idle_ms
        self.state, self.shown = state, list(shown)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", self.state)

    def _known(self) -> tuple[pd.DataFrame, int | None]:
        lots, n, total, last, timer = self.seen.get() or ([], [], [], [], None)
        known = pd.DataFrame({"n": pd.Series(n, dtype="int64"), "total": pd.Series(total, dtype="float64"),
                              "last": pd.Series(last, dtype="int64")})
        return known.set_index(pd.Index(lots, dtype=object)), timer

    def _keep(self, known: pd.DataFrame, timer: int | None) -> None:
        """Store the bucket's lots, with a timer no later than the first of them is due."""
        if known.empty:
            self.seen.clear()
            return
        due = int(known["last"].min()) + self.idle_ms
        if timer is None or due < timer:
            self.handle.registerTimer(due)
            timer = due
        self.seen.update((known.index.tolist(), known["n"].tolist(), known["total"].tolist(), known["last"].tolist(), timer))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True)
        alone = arrived[self.lot].isna()  # no lot, so nothing to average with
        if alone.any():
            yield arrived[alone].assign(lot_rate=arrived[self.rate])[self.shown]
            arrived = arrived[~alone]
        if arrived.empty:
            return
        code, lots = pd.factorize(arrived[self.lot])
        arrived = arrived.assign(_code=code).sort_values(["_code", self.time, *self.order], kind="stable", ignore_index=True)
        rate, code = arrived[self.rate], arrived["_code"]
        at = arrived[self.time].astype("datetime64[ms]").astype("int64")
        known, timer = self._known()
        before = known.reindex(lots).reset_index(drop=True).loc[code].reset_index(drop=True)
        # After a pause the count starts anew, whether or not the timer has fired by now.
        pause = at - at.groupby(code).shift().fillna(before["last"]) > self.idle_ms
        spell = pause.groupby(code).cumsum()
        first = spell == 0
        counts = rate.notna().groupby([code, spell]).cumsum() + before["n"].fillna(0).where(first, 0)
        running = rate.fillna(0.0).groupby([code, spell]).cumsum() + before["total"].fillna(0.0).where(first, 0.0)
        ends = ~code.duplicated(keep="last")
        now = pd.DataFrame({"n": counts[ends].astype("int64"), "total": running[ends], "last": at[ends]}).set_index(
            pd.Index(lots[code[ends]], dtype=object))
        kept = known[~known.index.isin(now.index)]
        self._keep(pd.concat([kept, now]) if len(kept) else now, timer)
        yield arrived.assign(lot_rate=running / counts.where(counts > 0))[self.shown]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known, timer = self._known()
        if timer is not None and timer <= timerValues.getCurrentWatermarkInMs():
            self._keep(known[known["last"] + self.idle_ms > timerValues.getCurrentWatermarkInMs()], None)
        yield from ()

    def close(self) -> None:
        pass


def with_lot_rates(stream: DataFrame, time: str, delay: str, idle_days: int, lot: str = "material_lot",
                   rate: str = "observed_defect_rate", order: Sequence[str] = ("batch_id",), buckets: int = 1024) -> DataFrame:
    """Arrivals with ``lot_rate``, the mean rate of their lot up to and with each of them.

    A lot's count and sum live in the state store, so arrivals of earlier triggers count and a
    restart goes on from them; a lot without arrivals for ``idle_days`` is forgotten. Arrivals
    of one trigger follow in the order of ``time`` and ``order``; rows without a lot keep their
    own rate. Lots are grouped by hash into ``buckets``, each one state; the number belongs to the
    checkpoint. Needs the RocksDB state store (``durable_state``).
    """
    schema = StructType([*stream.schema, StructField("lot_rate", DoubleType())])
    state = StructType([
        StructField("lots", ArrayType(stream.schema[lot].dataType)), StructField("n", ArrayType(LongType())),
        StructField("total", ArrayType(DoubleType())), StructField("last", ArrayType(LongType())), StructField("timer", LongType())])
    # Rows without a lot are dealt by what they are ordered by, so that they don't meet in one bucket.
    hashed = F.when(F.col(lot).isNotNull(), F.xxhash64(lot)).otherwise(F.xxhash64(time, *order))
    dealt = stream.withWatermark(time, delay).withColumn("_bucket", F.pmod(hashed, F.lit(buckets)))
    return dealt.groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=_LotMean(lot, rate, time, order, idle_days * 86_400_000, state, schema.names), outputStructType=schema,
        outputMode="append", timeMode="eventTime")


@contextmanager
def durable_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, on disk beside the checkpoint and not
    on the executors' heap; the session's own setting comes back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def arrival_alerts(stream: DataFrame, baseline: DataFrame, risk: DataFrame,
                   params: DetectionParams, lot_averages: DataFrame | None = None) -> DataFrame:
    """Status of each arriving batch measurement against static baseline and risk tables.

    The lot's rate is that of ``with_lot_rates`` where the stream went through it, else that of
    a static table, else the arrival's own.
    """
    rows = detection.with_risk(stream, risk, params).join(
        baseline, ["supplier_id", "line_id"], "left")
    if "lot_rate" in stream.columns:
        rows = rows.withColumn("lot_rate", F.coalesce("lot_rate", "observed_defect_rate"))
    elif lot_averages is None:
        rows = rows.withColumn("lot_rate", F.col("observed_defect_rate"))
    else:
        rows = rows.join(lot_averages, "material_lot", "left").withColumn(
            "lot_rate", F.coalesce("lot_avg_rate", "observed_defect_rate"))
    rate, mean, std = (F.col(c) for c in ("observed_defect_rate", "mean_rate", "std_rate"))
    return rows.withColumns({
        "is_outlier": F.lit(False),
        "z": detection.z_score(rate, mean, std),
        "threshold": detection.effective_threshold(F.col("risk_tier"), params),
    }).withColumn("alert_status", detection.alert_status(params))


def run_to_table(stream: DataFrame, folder: str, available_now: bool = True) -> DataFrame:
    """Drain a stream into a Parquet table and read the table back; state is kept in RocksDB."""
    with durable_state(stream.sparkSession):
        query = (
            stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{folder}/_checkpoint")
            .trigger(**({"availableNow": True} if available_now else {"processingTime": "15 minutes"}))
            .start(f"{folder}/table")
        )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/table")
