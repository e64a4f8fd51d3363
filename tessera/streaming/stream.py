"""Structured Streaming re-aims of the reference's periodic monitoring (ST1, ST2).

The operators take a streaming DataFrame and return a streaming DataFrame;
:func:`run_available` drives a query with the ``availableNow`` trigger into a
parquet sink in the shared checkpoint folder (never a driver-side memory
sink) and returns the sink as a batch DataFrame.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import ensure_checkpoint_dir

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def read_stream(spark: SparkSession, directory: str, file_glob: str, schema: T.StructType,
                max_files: int | None = None) -> DataFrame:
    """A parquet file stream over the files of ``directory`` matching ``file_glob``."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(directory)


def stream_score(stream: DataFrame, key: str, rules: Mapping[str, object]) -> DataFrame:
    """ST1: stateless alerts -- one output row per (event, fired rule).

    ``rules`` maps an alert name to a boolean Column over the event.
    """
    fired = F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    return stream.select(key, *[c for c in stream.columns if c != key],
                         F.explode(F.array_compact(fired)).alias("alert"))


def stream_model(stream: DataFrame, model: PipelineModel) -> DataFrame:
    """ST1: arriving rows with a fitted pipeline's ``prediction`` and, from a classifier, ``probs`` (one per class).

    Nothing is fitted on the stream, so a row is scored as in a batch.  Rules over the result go to
    :func:`stream_score`.
    """
    out = model.transform(stream)
    probs = [vector_to_array("probability").alias("probs")] if "probability" in out.columns else []
    return out.select(*stream.columns, "prediction", *probs)


class _Runs(StatefulProcessor):
    """Per unit: the totals of the periods that the watermark has not passed, and the run of periods below zero so far.

    Both are one value, so a unit is read and written once a batch, and one timer waits for its earliest open period.
    When that fires, all periods that the watermark has passed are closed in order of time, so rows that arrive late
    but before the watermark count.
    """

    def __init__(self, seconds: int, least: int) -> None:
        self.seconds, self.least = seconds, least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.unit = handle.getValueState("unit", "open string, last long, length int, timer long")  # open: JSON of [start, total] pairs

    def _read(self) -> tuple[dict[int, float], int | None, int, int | None]:
        held = self.unit.get()
        if held is None:
            return {}, None, 0, None
        return dict(json.loads(held[0])), held[1], held[2], held[3]

    def _write(self, periods: dict[int, float], last: int | None, length: int, timer: int | None) -> None:
        due = (min(periods) + self.seconds) * 1000 if periods else None
        if due is not None and (timer is None or due < timer):
            self.handle.registerTimer(due)
            timer = due
        self.unit.update((json.dumps(list(periods.items())), last, length, timer))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        sums: dict[int, float] = {}
        for r in rows:
            sums[r["__start"]] = sums.get(r["__start"], 0.0) + (r["__value"] or 0.0)
        periods, last, length, timer = self._read()
        for start, total in sums.items():
            periods[start] = total + periods[start] if start in periods else total
        self._write(periods, last, length, timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until, passed = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        periods, last, length, timer = self._read()
        out = []
        for start in sorted(periods):
            end = (start + self.seconds) * 1000
            if end > until and end >= passed:  # a timer fires once the watermark is beyond it
                break
            total = periods.pop(start)
            length = 0 if total >= 0 else length + 1 if last == start - self.seconds else 1
            last = start
            if length >= self.least:
                out.append(Row(unit=key[0], start=start, total=total, run=length))
        self._write(periods, last, length, timer if timer is not None and timer > until else None)
        return iter(out)

    def close(self) -> None:
        pass


def sustained(stream: DataFrame, unit: str, ts: str, value: Column, seconds: int, least: int, watermark: str) -> DataFrame:
    """ST1: alerts for units whose ``value`` adds up to less than zero in ``least`` or more consecutive periods.

    Periods are ``seconds`` long, counted from 1970 by the timestamp (wall-clock time for TIMESTAMP_NTZ).  Once the
    watermark has passed a period it is closed: a period below zero that makes or goes on with a run of at least
    ``least`` of them puts out (unit, period_start, total, run).  A period without a row ends the run.  State per
    unit: the open periods' totals and the last run; null values count as 0, a null unit is a unit.
    """
    ntz = dict(stream.dtypes)[ts] == "timestamp_ntz"
    t = _event_time(stream, ts)
    kind = stream.schema[unit].dataType.simpleString()
    rows = stream.select(F.col(unit).alias("__unit"), t.alias("__ts"), value.cast("double").alias("__value")).withWatermark("__ts", watermark)
    rows = rows.withColumn("__start", F.floor(F.unix_micros("__ts") / (1_000_000 * seconds)).cast("long") * seconds)
    out = rows.groupBy("__unit").transformWithState(
        statefulProcessor=_Runs(seconds, least), outputStructType=f"unit {kind}, start long, total double, run int", outputMode="append", timeMode="eventTime")
    shown = F.timestamp_seconds("start")
    if ntz:
        shown = F.to_utc_timestamp(shown, stream.sparkSession.conf.get("spark.sql.session.timeZone")).cast("timestamp_ntz")
    return out.select("unit", shown.alias("period_start"), "total", "run")


def _event_time(stream: DataFrame, ts: str) -> Column:
    """The timestamp a watermark can be set on; wall-clock time is read as UTC, so windows align to it in any session zone."""
    if dict(stream.dtypes)[ts] == "timestamp_ntz":
        return F.from_utc_timestamp(F.col(ts).cast("timestamp"), stream.sparkSession.conf.get("spark.sql.session.timeZone"))
    return F.col(ts)


def stream_profile(stream: DataFrame, ts: str, window: str, watermark: str, value: str,
                   alert) -> DataFrame:
    """ST2: tumbling-window profile with a watermark.

    Columns: window_start, window_end, n, n_null (value), mean (value),
    n_alert.  The timestamp is cast to TIMESTAMP first (parquet TIMESTAMP_NTZ
    cannot carry a watermark).  In append mode a window is emitted once the
    watermark (max event time - delay) passes its end; state is dropped then,
    so memory stays bounded on an unbounded stream.
    """
    tz = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    s = stream.withColumn("__ts", _event_time(stream, ts)).withWatermark("__ts", watermark)
    g = s.groupBy(F.window("__ts", window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col(value).isNull(), 1).otherwise(0)).cast("long").alias("n_null"),
        F.avg(value).alias("mean"), F.sum(F.when(alert, 1).otherwise(0)).cast("long").alias("n_alert"))
    wall = (lambda c: F.to_utc_timestamp(c, tz).cast("timestamp_ntz")) if dict(stream.dtypes)[ts] == "timestamp_ntz" \
        else (lambda c: c)
    return g.select(wall(F.col("w.start")).alias("window_start"), wall(F.col("w.end")).alias("window_end"),
                    "n", "n_null", "mean", "n_alert")


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _state_store(spark: SparkSession):
    """Keyed state with timers and maps needs the RocksDB store, unless the session names one."""
    named = spark.conf.get(_PROVIDER, None)
    plain = named is None or named.endswith(".HDFSBackedStateStoreProvider")
    if plain:
        spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if plain:
            spark.conf.unset(_PROVIDER) if named is None else spark.conf.set(_PROVIDER, named)


def run_available(stream: DataFrame, name: str, mode: str = "append", base: str | None = None) -> DataFrame:
    """Run ``stream`` to the end of the available input; return the sink as a batch DataFrame.

    ``base`` is the folder of sink and checkpoint.  A run with the folder of an earlier one goes on where that
    ended: its files are not read again and its state is kept.
    """
    spark = stream.sparkSession
    base = base or os.path.join(ensure_checkpoint_dir(spark), f"stream-{name}-{uuid.uuid4().hex[:8]}")
    out, chk = os.path.join(base, "out"), os.path.join(base, "chk")
    with _state_store(spark):
        q = (stream.writeStream.format("parquet").outputMode(mode).option("path", out)
             .option("checkpointLocation", chk).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
