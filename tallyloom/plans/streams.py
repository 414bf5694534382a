"""Streaming."""

from pyspark.sql import functions as F

from tallyloom.plans.registry import Tables, query
from tallyloom.session import scratch_path
from tallyloom.streaming import alerts

_CENTRE, _REACH, _SUNRISE, _SUNSET = (49.5, 50.0), 30, 6, 18


def filtered(df):
    k = F.get_json_object("props", "$.k").cast("double")
    seen = alerts.overhead_in_the_dark(
        df, F.col("value"), k, F.col("ts"), _CENTRE, _REACH, _SUNRISE, _SUNSET
    )
    return seen.select("event_id", "user_id", "value")


@query(
    "stm_poll_alert",
    """SELECT event_id, user_id, value FROM events
       WHERE value BETWEEN 19.5 AND 79.5 AND CAST(json_extract_string(props, '$.k') AS DOUBLE) BETWEEN 20 AND 80
         AND (hour(ts) >= 18 OR hour(ts) <= 6)""",
)
def poll_alerts(t: Tables):
    sightings = alerts.open_stream(t.spark, f"{t.root}/events.parquet", t.events.schema)
    out = scratch_path(t.spark, "alerts")
    run = alerts.start_alerts(filtered(sightings), out, scratch_path(t.spark, "alerts-log"), once=True)
    run.awaitTermination()
    return t.spark.read.schema("event_id bigint, user_id bigint, value double").parquet(out)
