"""Run logs and metrics: the events table, with the user as the run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep import operators as op
from corpusprep.plans.inputs import events

RUN = "user_id"
ORDER = ["ts", "event_id"]


def latest_event(spark: SparkSession, folder: str) -> DataFrame:
    return op.latest_per_key(events(spark, folder), RUN, ORDER)


def rolling_metric(spark: SparkSession, folder: str) -> DataFrame:
    metrics = events(spark, folder).select(RUN, *ORDER, "value")
    rolled = op.rolling_mean(metrics, RUN, ORDER, "value", n=10)
    return rolled.select(RUN, "event_id", F.round("rolling_mean", 6).alias("rolling_mean"))


def metric_every_n(spark: SparkSession, folder: str) -> DataFrame:
    metrics = events(spark, folder).select(RUN, *ORDER, "value")
    return op.every_nth(metrics, 10, RUN, ORDER)


def run_timeline(spark: SparkSession, folder: str) -> DataFrame:
    return op.run_timeline(events(spark, folder).select(RUN, *ORDER, "event_type", "value"), RUN, ORDER)


QUERIES = {
    "latest_event": latest_event,
    "rolling_metric": rolling_metric,
    "metric_every_n": metric_every_n,
    "run_timeline": run_timeline,
}

_IN_RUN = "over (partition by user_id order by ts, event_id)"

ORACLES = {
    "latest_event": """
        select * from events
        qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "rolling_metric": """
        select user_id, event_id, round(avg(value) over (
          partition by user_id order by ts, event_id rows between 9 preceding and current row), 6) as rolling_mean
        from events""",
    "metric_every_n": f"""
        select * from (select user_id, ts, event_id, value, row_number() {_IN_RUN} as step from events)
        where step % 10 = 0""",
    "run_timeline": f"""
        select user_id, ts, event_id, event_type, value, row_number() {_IN_RUN} - 1 as position from events""",
}
