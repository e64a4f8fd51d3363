"""Streaming queries (ST1, ST2) over the events table as a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.models import build_model
from ..sources.tables import load
from ..streaming.stream import EVENTS_SCHEMA, read_stream, run_available, stream_model, stream_profile, stream_score, sustained
from .common import R, rounded
from .registry import query

VALUE_ALERT = 300.0


@query("stream_score", sql=f"""
SELECT event_id, ts, user_id, event_type, value, props, 'high_value' AS alert FROM events WHERE value > {VALUE_ALERT}
UNION ALL
SELECT event_id, ts, user_id, event_type, value, props, 'error' AS alert FROM events WHERE event_type = 'error'
""")
def q_stream_score(spark, sf):
    s = read_stream(spark, sf, "events.parquet", EVENTS_SCHEMA)
    alerts = stream_score(s, "event_id", {"high_value": F.col("value") > VALUE_ALERT,
                                          "error": F.col("event_type") == "error"})
    return run_available(alerts, "score")


@query("stream_profile", sql=f"""
WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, value, event_type FROM events),
m AS (SELECT max(ts) - INTERVAL 1 HOUR AS wm FROM events)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS n,
       CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null, {R('avg(value)')} AS mean,
       CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_alert
FROM w, m GROUP BY window_start, wm HAVING window_start + INTERVAL 1 DAY <= wm
""")
def q_stream_profile(spark, sf):
    s = read_stream(spark, sf, "events.parquet", EVENTS_SCHEMA)
    p = stream_profile(s, "ts", "1 day", "1 hour", "value", F.col("event_type") == "error")
    out = run_available(p, "profile")
    return rounded(out.select("window_start", "window_end", "n", "n_null", "mean", "n_alert"))


TRAIN_UNTIL, SURPRISE = "2024-01-16", 150.0


@query("stream_model", sql=f"""
WITH e AS (SELECT event_id, ts, value, CAST(hour(ts) AS DOUBLE) AS hour FROM events),
m AS (SELECT regr_slope(value, hour) AS b, regr_intercept(value, hour) AS a FROM e WHERE ts < TIMESTAMP '{TRAIN_UNTIL}'),
s AS (SELECT event_id, a + b * hour AS prediction, value - (a + b * hour) AS surprise FROM e, m)
SELECT event_id, {R('prediction')} AS prediction, {R('surprise')} AS surprise, CASE WHEN surprise > {SURPRISE} THEN 'high' ELSE 'low' END AS alert
FROM s WHERE abs(surprise) > {SURPRISE}
""")
def q_stream_model(spark, sf):
    """A regression fitted on the events up to a day, on the stream of all of them; alerts far from what it expects."""
    hour = F.hour("ts").cast("double").alias("hour")
    train = load(spark, sf, "events").where(F.col("ts") < F.lit(TRAIN_UNTIL).cast("timestamp_ntz")).select("value", hour)
    model = build_model("linear", ["hour"], "value").fit(train)
    s = stream_model(read_stream(spark, sf, "events.parquet", EVENTS_SCHEMA).select("event_id", "value", hour), model)
    s = s.select("event_id", "prediction", (F.col("value") - F.col("prediction")).alias("surprise"))
    alerts = stream_score(s, "event_id", {"high": F.col("surprise") > SURPRISE, "low": F.col("surprise") < -SURPRISE})
    return rounded(run_available(alerts, "model"))


@query("sustained_alerts", sql=f"""
WITH d AS (SELECT user_id AS unit, CAST(ts AS DATE) AS day, sum(CASE WHEN event_type IN ('purchase', 'signup') THEN value ELSE -value END) AS total
           FROM events GROUP BY 1, 2),
m AS (SELECT max(ts) - INTERVAL 1 HOUR AS wm FROM events),
n AS (SELECT unit, day, total, day - CAST(row_number() OVER (PARTITION BY unit ORDER BY day) AS INTEGER) AS island
      FROM d, m WHERE total < 0 AND day + INTERVAL 1 DAY <= wm),
r AS (SELECT unit, day, total, CAST(row_number() OVER (PARTITION BY unit, island ORDER BY day) AS INTEGER) AS run FROM n)
SELECT unit, CAST(day AS TIMESTAMP) AS period_start, {R('total')} AS total, run FROM r WHERE run >= 3
""")
def q_sustained_alerts(spark, sf):
    """Users whose daily flow is below zero for three days or more, by keyed state over the event stream."""
    flow = F.when(F.col("event_type").isin("purchase", "signup"), F.col("value")).otherwise(-F.col("value"))
    s = read_stream(spark, sf, "events.parquet", EVENTS_SCHEMA)
    return rounded(run_available(sustained(s, "user_id", "ts", flow, 86_400, 3, "1 hour"), "sustained"))
