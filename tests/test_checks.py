import datetime as dt
import decimal
from decimal import Decimal

import pytest
from frames import broken, broken_in, frame

from pyspark.sql import functions as F

from sluicegate.errors import ContractError
from sluicegate.functions.checks import FIELD_CHECKS
from sluicegate.functions.operand import Operand
from sluicegate.operators.check import check
from sluicegate.rules import parse_rules

YES, NO = True, False


def test_required(spark):
    given = [None, "", "  ", "\t\n ", "x", " x "]
    assert broken(spark, "string", given, {"rule": "required"}) == [YES, YES, YES, YES, NO, NO]
    assert broken(spark, "int", [None, 0], {"rule": "notnull"}) == [YES, NO]


def test_limits(spark):
    given = [4.9, 5.0, 5.1, None, float("nan")]
    assert broken(spark, "double", given, {"rule": "min", "value": 5}) == [YES, NO, NO, NO, NO]
    assert broken(spark, "double", given, {"rule": "ge", "value": "5"}) == [YES, NO, NO, NO, NO]
    assert broken(spark, "double", given, {"rule": "gt", "value": 5}) == [YES, YES, NO, NO, NO]
    assert broken(spark, "double", given, {"rule": "max", "value": 5}) == [NO, NO, YES, NO, YES]


def test_limits_on_text_dates_and_decimals(spark):
    assert broken(spark, "string", ["4", " 4", "4d", "x", "6"], {"rule": "min", "value": 5}) == [YES, NO, NO, NO, NO]
    assert broken(spark, "date", [dt.date(1970, 1, 3), None], {"rule": "max", "value": 1}) == [YES, NO]
    assert broken(spark, "decimal(10,2)", [Decimal("4.99"), Decimal("5")], {"rule": "min", "value": 5}) == [YES, NO]


def test_max_length_counts_characters(spark):
    assert broken(spark, "string", ["ab", "abc", "😀😀", None], {"rule": "len_max", "value": 2}) == [NO, YES, NO, NO]
    assert broken(spark, "int", [12, 123], {"rule": "max_length", "value": 2}) == [NO, YES]


def test_regex_searches_anywhere(spark):
    assert broken(spark, "string", ["xabx", "ba", None], {"rule": "regex", "pattern": " ab "}) == [NO, YES, NO]


def test_in_compares_text(spark):
    assert broken(spark, "int", [1, 2, 3, None], {"rule": "in", "values": [1, "2"]}) == [NO, NO, YES, NO]
    assert broken(spark, "double", [1e7, 1.5], {"rule": "in", "values": [10000000.0]}) == [NO, YES]


def test_date_limits(spark):
    days = ["2023-12-31", "2024-01-01", "2024-01-02", "x", None]
    assert broken(spark, "string", days, {"rule": "date_gte", "value": "2024-01-01"}) == [YES, NO, NO, NO, NO]
    assert broken(spark, "string", days, {"rule": "date_lte", "value": "2024-01-01T10:00"}) == [NO, NO, YES, NO, NO]
    times = [dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2)]
    assert broken(spark, "timestamp_ntz", times, {"rule": "date_lte", "value": "2024-01-01"}) == [NO, YES]


def test_date_format(spark):
    days = ["2024-01-05", " 2024-01-05 ", "2024-02-30", "05/01/2024", "", "  ", None]
    assert broken(spark, "string", days, {"rule": "date_format"}) == [NO, NO, YES, YES, NO, NO, NO]
    assert broken(spark, "string", days, {"rule": "date_format", "format": "DD/MM/YYYY"}) == [
        YES, YES, YES, NO, NO, NO, NO,
    ]
    assert broken(spark, "string", ["20240105", "x"], {"rule": "date_format", "format": "%Y%m%d"}) == [NO, YES]
    assert broken(spark, "date", [dt.date(2024, 1, 5), None], {"rule": "date_format", "format": "dd/mm/yyyy"}) == [YES, NO]


def test_decimal_scale(spark):
    given = ["1", "-1.5", "1,25", "1.256", "12,345", ".5", "abc", " 1.2 ", "", " ", None]
    assert broken(spark, "string", given, {"rule": "decimal_scale", "scale": 2}) == [
        NO, NO, NO, YES, YES, YES, YES, NO, NO, NO, NO,
    ]
    assert broken(spark, "string", ["1", "1.0", "1\n2"], {"rule": "decimal_scale", "scale": 0}) == [NO, YES, YES]
    assert broken(spark, "double", [1.5, 1.25, 1e20], {"rule": "decimal_scale", "scale": 1}) == [NO, YES, YES]
    assert broken(spark, "decimal(10,2)", [Decimal("1.5")], {"rule": "decimal_scale", "scale": 1}) == [YES]


def test_document_by_type(spark):
    rows = [
        (0, "1", "123.456.789-01"),
        (1, "1", "123"),
        (2, "2", "12.345.678/0001-01"),
        (3, "2", "12345678901"),
        (4, "1", None),
        (5, None, None),
        (6, "3", "1"),
        (7, " 1 ", "1"),
    ]
    df = spark.createDataFrame(rows, "k int, tipo_credor string, cpf_cnpj_credor string")
    rules = parse_rules({"fields": {}, "validations": [{"rule": "cpf_cnpj_by_tipo_credor"}]}).checks
    bad = sorted(r.k for r in check(df, rules).invalid.collect())
    assert bad == [1, 3, 4]
    renamed = df.toDF("k", "kind", "doc")
    args = {"tipo_field": "kind", "doc_field": "doc"}
    rules = parse_rules({"fields": {}, "validations": [{"rule": "cpf_cnpj_by_tipo_credor", "args": args}]}).checks
    assert sorted(r.k for r in check(renamed, rules).invalid.collect()) == bad


def test_rules_under_a_condition(spark):
    df = spark.createDataFrame([(0, "a", 9.0), (1, "b", 9.0), (2, None, 9.0), (3, "a", 1.0)], "k int, flag string, v double")

    def run(**when):
        return broken_in(df, "v", {"rule": "max", "value": 5, "when": {"field": "flag", **when}})

    assert run(op="eq", value="a") == [YES, NO, NO, NO]
    assert run(op="NE", value="a") == [NO, YES, NO, NO]
    assert run(op="in", value=["a", None]) == [YES, NO, NO, NO]
    assert run(op="in", value="a") == [YES, NO, NO, NO]
    assert run(op="nin", value=["a", None]) == [NO, YES, NO, NO]
    assert run(op="isnull") == [NO, NO, YES, NO]
    assert run(op="notnull") == [YES, YES, NO, NO]
    assert run(op="eq") == [NO, NO, NO, NO]
    assert run(op="like", value="a") == [YES, YES, YES, NO]


def test_conditions_take_the_type_of_the_literal(spark):
    df = spark.createDataFrame([(0, "1", 9), (1, "1.0", 9), (2, "x", 9)], "k int, flag string, v int")

    def run(op, value):
        return broken_in(df, "v", {"rule": "max", "value": 5, "when": {"field": "flag", "op": op, "value": value}})

    assert run("eq", 1) == [YES, NO, NO]
    assert run("eq", 1.0) == [YES, YES, NO]
    assert run("eq", "1") == [YES, NO, NO]
    assert run("in", [1, 2.0]) == [YES, NO, NO]
    assert run("eq", True) == [NO, NO, NO]
    with pytest.raises(ContractError):
        run("in", [1, "a"])


def test_rules_that_do_not_run_are_noted(spark):
    items = [
        {"rule": "max"},
        {"rule": "regex", "pattern": " "},
        {"rule": "in", "values": []},
        {"rule": "shape", "value": 1},
        {"rule": "cpf_cnpj_by_tipo_credor"},
    ]
    document = {
        "fields": {"v": {"validate": items}},
        "validations": [{"rule": "required"}, {"rule": "required", "field": "*"}],
    }
    result = check(frame(spark, "string", [None]), parse_rules(document).checks)
    assert result.checks == () and len(result.notes) == 7
    assert result.valid.count() == 1 and result.invalid.count() == 0 and result.warning.count() == 0


def test_unreadable_condition_is_noted_and_ignored(spark):
    rule = {"rule": "required", "when": {"op": "eq", "value": 1}}
    result = check(frame(spark, "string", [None]), parse_rules({"fields": {"v": {"validate": [rule]}}}).checks)
    assert result.invalid.count() == 1 and "every row" in result.notes[0]


def test_checks_on_absent_columns_fail_early(spark):
    for rule in ({"rule": "required"}, {"rule": "required", "when": {"field": "gone", "op": "isnull"}}):
        field = "v" if "when" in rule else "gone"
        with pytest.raises(ContractError, match="gone"):
            broken_in(frame(spark, "string", ["a"]), field, rule)


def test_millisecond_columns_show_three_digits(spark):
    rule = {"rule": "regex", "pattern": r"\.\d{3}$"}
    times = [dt.datetime(2024, 1, 1)]
    assert broken(spark, "timestamp_ntz", times, rule, millis=["v"]) == [NO]
    assert broken(spark, "timestamp_ntz", times, rule) == [YES]


def test_limits_on_whole_numbers(spark):
    given = [4, 5, 6, None, 2**62, -(2**62)]
    assert broken(spark, "bigint", given, {"rule": "min", "value": 4.5}) == [YES, NO, NO, NO, NO, YES]
    assert broken(spark, "bigint", given, {"rule": "max", "value": 5.5}) == [NO, NO, YES, NO, YES, NO]
    assert broken(spark, "bigint", given, {"rule": "gt", "value": "5"}) == [YES, YES, NO, NO, NO, YES]
    assert broken(spark, "bigint", given, {"rule": "max", "value": 1e300}) == [NO] * 6
    assert broken(spark, "bigint", given, {"rule": "min", "value": "-inf"}) == [NO] * 6


@pytest.mark.parametrize("kind", ["decimal(18,2)", "decimal(38,18)", "decimal(38,0)", "decimal(5,5)", "decimal(20,3)"])
def test_decimal_limits_are_those_of_doubles(spark, kind):
    """Limits and values around the places where decimals and doubles part."""
    import random

    scale, most = int(kind[:-1].split(",")[1]), int(kind[8:].split(",")[0])
    chance = random.Random(kind)
    limits = [0, 0.1, -0.1, 0.3, 100.5, 1e15 + 0.3, 2.0**53, 2.0**53 + 2, -(2.0**60), 1e25, -1e40, 1e300, 5e-324, 0.99999, 1 / 3]
    with decimal.localcontext() as context:
        context.prec, step = 60, Decimal(1).scaleb(-scale)
        given = [Decimal(0), None]
        for limit in limits:
            near = Decimal(limit) if abs(limit) < 10 ** (most - scale) else Decimal(chance.randint(-9, 9))
            at = near.quantize(step)
            given += [at + k * step for k in (-2, -1, 0, 1, 2, chance.randint(-(10**6), 10**6))]
        given = [v for v in given if v is None or abs(v) < Decimal(10) ** (most - scale)]
    tests = [(rule, limit, bad) for limit in limits for rule, bad in (("min", float.__lt__), ("max", float.__gt__), ("gt", float.__le__))]
    df = frame(spark, kind, given)
    x = Operand(F.col("v"), df.schema["v"].dataType)
    columns = [F.coalesce(FIELD_CHECKS[rule](x, {"value": limit}), F.lit(False)) for rule, limit, _ in tests]
    got = df.orderBy("k").select(*columns, F.coalesce(FIELD_CHECKS["max"](x, {"value": "nan"}), F.lit(False))).collect()
    for n, (rule, limit, bad) in enumerate(tests):
        wanted = [v is not None and bad(float(v), float(limit)) for v in given]
        assert [row[n] for row in got] == wanted, (rule, limit)
    assert not any(row[-1] for row in got)
