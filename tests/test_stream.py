"""Streaming output equals the batch computation over the same files."""

import os
import random
import time
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from paths import SF_SMALL
from tessera.operators.models import build_model
from tessera.streaming.stream import EVENTS_SCHEMA, read_stream, run_available, stream_model, stream_profile, stream_score, sustained


def test_stream_score_equals_batch(spark):
    s = read_stream(spark, SF_SMALL, "events.parquet", EVENTS_SCHEMA, max_files=1)
    out = run_available(stream_score(s, "event_id", {"err": F.col("event_type") == "error"}), "t1")
    batch = spark.read.parquet(f"{SF_SMALL}/events.parquet").where("event_type = 'error'")
    assert out.count() == batch.count()
    assert out.join(batch, "event_id", "left_anti").count() == 0


def test_stream_profile_closed_windows_equal_batch(spark):
    s = read_stream(spark, SF_SMALL, "events.parquet", EVENTS_SCHEMA)
    out = run_available(stream_profile(s, "ts", "1 day", "1 hour", "value", F.lit(False)), "t2")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("t", F.col("ts").cast("timestamp"))
    wm = ev.agg(F.max("t")).first()[0]
    batch = ev.groupBy(F.window("t", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n2")) \
        .where(F.col("w.end") <= F.lit(wm) - F.expr("INTERVAL 1 HOUR"))
    j = out.join(batch, out.window_start == batch["w.start"])
    assert out.count() == batch.count() == j.count()
    assert j.where("n <> n2").count() == 0


def _runs(rows, closed, least):
    """Sustained alerts by definition over (unit, ts, value)."""
    total = defaultdict(float)
    for unit, ts, value in rows:
        total[unit, ts.replace(minute=0, second=0, microsecond=0)] += value or 0.0
    out = {}
    for (unit, hour), _ in total.items():
        run = 0
        while total.get((unit, hour - timedelta(hours=run)), 0.0) < 0:
            run += 1
        if run >= least and hour + timedelta(hours=1) <= closed:
            out[unit, hour] = (round(total[unit, hour], 6), run)
    return out


def test_sustained_alerts_with_late_rows_and_a_restart(spark, tmp_path):
    rng, day = random.Random(5), datetime(2024, 3, 1)
    rows = [(rng.randrange(6), day + timedelta(minutes=rng.random() * 60 * 40), rng.choice([None, -3.0, -2.0, -1.0, 1.0])) for _ in range(600)]
    rows += [(7, day + timedelta(hours=h, minutes=30), -1.0) for h in (0, 1, 2, 4, 5, 6, 7)]  # a gap at 3
    by_time = sorted(rows, key=lambda r: r[1])
    # files in order of time, but up to 90 minutes late: the rows of a file reach back into the one before
    arriving = sorted(by_time, key=lambda r: r[1] + timedelta(minutes=rng.random() * 90))
    folder = str(tmp_path / "in")

    def write(part, k):
        spark.createDataFrame(part, "unit long, ts timestamp_ntz, value double").coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)  # the stream takes files by their time

    schema = spark.createDataFrame([], "unit long, ts timestamp_ntz, value double").schema
    step = len(arriving) // 6

    def run():
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        return run_available(sustained(s, "unit", "ts", F.col("value"), 3600, 3, "3 hours"), "sustained", base=str(tmp_path / "run"))

    for k in range(4):
        write(arriving[k * step: (k + 1) * step], k)
    first = run().count()
    write(arriving[4 * step:], 4)
    write([(7, day, -50.0)], 5)  # far behind the watermark: left out
    out = run()
    got = {(r["unit"], r["period_start"]): (round(r["total"], 6), r["run"]) for r in out.collect()}
    closed = max(r[1] for r in rows) - timedelta(hours=3)
    assert got == _runs(rows, closed, 3) and len(got) == out.count() > first > 0
    assert (7, day + timedelta(hours=2)) in got and (7, day + timedelta(hours=5)) not in got and got[7, day + timedelta(hours=7)][1] == 4


def test_sustained_of_nothing(spark, tmp_path):
    schema = spark.createDataFrame([], "unit string, ts timestamp, value double").schema
    os.makedirs(tmp_path / "none")
    s = spark.readStream.schema(schema).parquet(str(tmp_path / "none"))
    assert run_available(sustained(s, "unit", "ts", F.col("value"), 60, 2, "1 hour"), "none").count() == 0


def test_model_on_a_stream_scores_as_in_a_batch(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    rows = ev.selectExpr("event_id", "value", "cast(hour(ts) as double) as hour", "cast(event_type = 'error' as int) as y")
    model = build_model("logistic", ["value", "hour"], "y", n_rows=rows.count(), scale=True).fit(rows)
    s = read_stream(spark, SF_SMALL, "events.parquet", EVENTS_SCHEMA).selectExpr("event_id", "value", "cast(hour(ts) as double) as hour")
    got = {r["event_id"]: (r["prediction"], r["probs"]) for r in run_available(stream_model(s, model), "model").collect()}
    from pyspark.ml.functions import vector_to_array
    want = {r["event_id"]: (r["prediction"], r["probs"]) for r in model.transform(rows).select("event_id", "prediction", vector_to_array("probability").alias("probs")).collect()}
    assert got == want


def test_a_unit_waits_on_one_timer_however_many_periods_are_open(spark):
    from types import SimpleNamespace

    from tessera.streaming.stream import _Runs
    held, timers, calls = [], [], []
    state = SimpleNamespace(get=lambda: calls.append("get") or (held[-1] if held else None), update=lambda v: calls.append("update") or held.append(v))
    runs = _Runs(10, 2)
    runs.init(SimpleNamespace(getValueState=lambda *_: state, registerTimer=timers.append))
    list(runs.handleInputRows((1,), iter([{"__start": s, "__value": -1.0} for s in (30, 0, 10, 20, 50)]), None))
    assert timers == [10_000] and calls == ["get", "update"]

    def fire(at, watermark):
        return [(r["start"], r["run"]) for r in runs.handleExpiredTimer((1,), SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark), SimpleNamespace(getExpiryTimeInMs=lambda: at))]
    assert fire(10_000, 35_000) == [(10, 2), (20, 3)] and timers == [10_000, 40_000]  # 30 ends at 40: still open
    assert fire(40_000, 90_000) == [(30, 4)] and len(calls) == 6  # 40 had no row: 50 begins a new run
