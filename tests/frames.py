"""Small frames and one-rule runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluicegate.functions.casts import convert, parse_token
from sluicegate.functions.operand import Operand, column
from sluicegate.operators.check import check
from sluicegate.operators.cleanup import clean
from sluicegate.rules import parse_rules


def frame(spark, kind, values, name="v"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"k int, `{name}` {kind}").coalesce(1)


def values(df, name="v"):
    return [row[0] for row in df.orderBy("k").select(column(name)).collect()]


def cast_to(spark, kind, given, token, digits=6):
    df = frame(spark, kind, given)
    operand = Operand(F.col("v"), df.schema["v"].dataType, digits)
    return values(df.withColumn("v", convert(operand, parse_token(token)).col))


def clean_with(spark, kind, given, *items):
    rules = parse_rules({"fields": {"v": {"normalize": list(items)}}}).cleanups
    return values(clean(frame(spark, kind, given), rules).frame)


def broken(spark, kind, given, *items, millis=()):
    """Which values break any of the rules."""
    return broken_in(frame(spark, kind, given), "v", *items, millis=millis)


def broken_in(df, field, *items, millis=()):
    rules = parse_rules({"fields": {field: {"validate": list(items)}}}).checks
    bad = {row.k for row in check(df, rules, millis).invalid.select("k").collect()}
    return [row.k in bad for row in df.orderBy("k").select("k").collect()]
