"""Conditions: a rule that applies to some rows only."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.queries.base import checked, query, table

BASE = "select event_id, event_type, user_id, value from events where value > 50 and "


def _over_fifty(events: DataFrame, when: dict[str, Any]) -> DataFrame:
    result = checked(events, {"value": [{"rule": "max", "value": 50, "when": when}]})
    return result.invalid.select("event_id", "event_type", "user_id", "value")


@query(BASE + "event_type = 'error'")
def when_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_fifty(table(spark, sf_dir, "events"), {"field": "event_type", "op": "eq", "value": "error"})


@query(BASE + "user_id <> 8")
def when_ne(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_fifty(table(spark, sf_dir, "events"), {"field": "user_id", "op": "ne", "value": 8})


@query(BASE + "event_type in ('error', 'view')")
def when_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    when = {"field": "event_type", "op": "in", "value": ["error", None, "view"]}
    return _over_fifty(table(spark, sf_dir, "events"), when)


@query(BASE + "user_id not in (8, 9)")
def when_nin(spark: SparkSession, sf_dir: str) -> DataFrame:
    when = {"field": "user_id", "op": "nin", "value": [8, None, 9]}
    return _over_fifty(table(spark, sf_dir, "events"), when)


@query(BASE + "nullif(event_type, 'error') is null")
def when_isnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_fifty(_with_gaps(spark, sf_dir), {"field": "known_type", "op": "isnull"})


@query(BASE + "nullif(event_type, 'error') is not null")
def when_notnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_fifty(_with_gaps(spark, sf_dir), {"field": "known_type", "op": "notnull"})


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.withColumn("known_type", F.nullif("event_type", F.lit("error")))
