"""No rule and no cast may fail on a type, whatever the values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluicegate.functions.casts import PLAIN_TOKENS, UNSIGNED_TOKENS
from sluicegate.functions.cleanups import OPERATIONS
from sluicegate.functions.checks import FIELD_CHECKS
from sluicegate.operators.check import check
from sluicegate.operators.cleanup import clean
from sluicegate.operators.schema import enforce
from sluicegate.rules import parse_rules

COLUMNS = {
    "c_string": ("string", ["x", " 12 ", "2024-01-05"]),
    "c_byte": ("tinyint", [-128, 0, 127]),
    "c_short": ("smallint", [-1, 0, 300]),
    "c_int": ("int", [-(2**31), 0, 2**31 - 1]),
    "c_long": ("bigint", [-(2**63), 0, 2**63 - 1]),
    "c_float": ("float", [float("nan"), -1e30, 0.5]),
    "c_double": ("double", [float("inf"), -1e300, 0.5]),
    "c_decimal": ("decimal(38,2)", [Decimal(-(10**35)), Decimal("0.5"), Decimal(10**35)]),
    "c_boolean": ("boolean", [True, False, True]),
    "c_date": ("date", [dt.date(1, 1, 1), dt.date(1970, 1, 1), dt.date(9999, 12, 31)]),
    "c_zoned": ("timestamp", [dt.datetime(1970, 1, 1), dt.datetime(2024, 1, 5, 1, 2, 3, 456), dt.datetime(9999, 12, 1)]),
    "c_plain": ("timestamp_ntz", [dt.datetime(1, 1, 1), dt.datetime(2024, 1, 5, 1, 2, 3, 456), dt.datetime(9999, 12, 31)]),
    "c_binary": ("binary", [b"", b"\xff", b"abc"]),
}
TOKENS = [*PLAIN_TOKENS, *UNSIGNED_TOKENS, "timestamp[ms]", "decimal128(10,2)", "list<int>"]
ARGUMENTS = {
    "value": 1, "scale": 1, "pattern": "a", "values": ["1"], "len": 3, "old": "a", "new": "b",
}


@pytest.fixture(scope="module")
def every(spark):
    rows = [*zip(*(values for _, values in COLUMNS.values())), (None,) * len(COLUMNS)]
    return spark.createDataFrame(rows, ", ".join(f"{n} {kind}" for n, (kind, _) in COLUMNS.items())).coalesce(1)


def _run(df):
    df.write.format("noop").mode("overwrite").save()


def test_casts(every):
    for token in TOKENS:
        typed = enforce(every, [{"name": n, "type": token} for n in COLUMNS])
        _run(typed)
        last = [r for r in typed.collect() if r.c_int is None and r.c_string is None]
        assert last and all(v is None for v in last[-1])


@pytest.mark.parametrize("name", sorted(OPERATIONS))
def test_cleanups(every, name):
    step = {"op": name, **ARGUMENTS}
    _run(clean(every, parse_rules({"fields": {n: {"normalize": [step]} for n in COLUMNS}}).cleanups).frame)
    when = {"field": "c_boolean", "op": "eq", "value": True}
    _run(clean(every, parse_rules({"fields": {n: {"normalize": [{**step, "when": when}]} for n in COLUMNS}}).cleanups).frame)


@pytest.mark.parametrize("name", sorted(FIELD_CHECKS))
def test_checks(every, name):
    rule = {"rule": name, **ARGUMENTS}
    if name.startswith("date_"):
        rule["value"] = "2024-01-01"
    result = check(every, parse_rules({"fields": {n: {"validate": [rule]} for n in COLUMNS}}).checks)
    assert len(result.checks) == len(COLUMNS)
    _run(result.frame)
    if name not in ("required", "notnull"):
        nulls = result.frame.where(" and ".join(f"{n} is null" for n in COLUMNS))
        assert nulls.where(F.array_contains(F.array(*[c.flag for c in result.checks]), True)).count() == 0


@pytest.mark.parametrize("value", ["x", 1, 1.5, True, None])
def test_conditions(every, value):
    fields = {}
    for name in COLUMNS:
        for op in ("eq", "ne", "in", "nin", "isnull", "notnull"):
            when = {"field": name, "op": op, "value": value}
            fields.setdefault("c_int", {"validate": []})["validate"].append({"rule": "required", "when": when})
    result = check(every, parse_rules({"fields": fields}).checks)
    _run(result.flags)
