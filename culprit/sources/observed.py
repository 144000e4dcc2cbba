"""Incidents observed in an event log: signals and labels read from its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culprit.fixed_values import LABEL

# Which cause an event type stands for; signups by value.
CAUSES = {
    "error": "bad_deployment",
    "view": "normal",
    "click": "traffic_spike",
    "purchase": "external_dependency_failure",
}
SIGNUP_LIMIT = 40.0


def observed_incidents(events: DataFrame, key: str = "incident_id", label: str = LABEL) -> DataFrame:
    """One incident per event with nine signals from its value, user, time and properties.

    Narrow: one scan of the five columns. A null column gives null signals; an event type
    without a cause gives a null label.
    """
    k = F.try_to_number(F.get_json_object("props", "$.k"), F.lit("999999999")).cast("double")
    value, user = F.col("value"), F.col("user_id")
    cause = F.when(F.col("event_type") == "signup", F.when(value > SIGNUP_LIMIT, "memory_leak").otherwise("cpu_saturation"))
    for kind, name in CAUSES.items():
        cause = F.when(F.col("event_type") == kind, name).otherwise(cause)
    return events.select(
        F.col("event_id").alias(key),
        F.least(value, F.lit(100.0)).alias("avg_cpu_usage"),
        (value / 10.0).alias("mem_growth"),
        (user % 7).cast("long").alias("oom_log_count"),
        (k * 10.0).alias("request_rate"),
        (value - F.floor(value)).alias("error_rate"),
        (value * 2.0 + 50.0).alias("latency"),
        (k / 100.0 - 0.5).alias("upstream_error_rate"),
        (F.minute("ts").cast("double") * 5.0 + 1.0).alias("dependency_latency"),
        F.second("ts").cast("long").alias("timeout_log_count"),
        cause.alias(label),
    )
