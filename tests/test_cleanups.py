import datetime as dt

import pytest
from frames import clean_with, frame, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluicegate.errors import ContractError
from sluicegate.operators.cleanup import clean
from sluicegate.rules import parse_rules

BLANKS = [None, "", "   ", "\t\n", " ", " x ", "　é "]


def test_trim_removes_unicode_whitespace(spark):
    assert clean_with(spark, "string", BLANKS, {"op": "trim"}) == [None, "", "", "", "", "x", "é"]


def test_case(spark):
    assert clean_with(spark, "string", ["aç", "ß", None], {"op": "upper"}) == ["AÇ", "SS", None]
    assert clean_with(spark, "string", ["AÇ"], {"op": "LOWER"}) == ["aç"]
    assert clean_with(spark, "int", [7], {"op": "upper"}) == ["7"]


def test_to_date(spark):
    given_dates = ["2024-01-05", "2024-02-30", "2024-01-05 10", "2024-1-5", "", None]
    assert clean_with(spark, "string", given_dates, {"op": "to_date"}) == [dt.date(2024, 1, 5)] + [None] * 5
    assert clean_with(spark, "int", [20240105], {"op": "to_date", "args": {"format": "%Y%m%d"}}) == [dt.date(2024, 1, 5)]


@pytest.mark.parametrize(
    "form", ["%Y-%m-%d", "%d/%m/%Y", "%Y%m%d", "dia %d.%m.%Y", "%F %T", "%H:%M|%d-%m-%Y", "%d %B %Y", "%j/%Y", "%y%m%d"]
)
def test_dates_against_the_standard_library(spark, form):
    pairs = [(m, d) for m in (1, 2, 12) for d in (1, 28, 29, 31) if m != 2 or d < 29]
    days = [dt.datetime(y, m, d, 13, 45, 59) for y in (1972, 1999, 2024) for m, d in pairs]
    texts = [d.strftime(form) for d in days]
    broken = [t[:-1] for t in texts] + [t + "0" for t in texts] + [" " + t for t in texts] + ["", "x", None]
    got = clean_with(spark, "string", [*texts, *broken], {"op": "to_date", "format": form})
    assert got == [d.date() for d in days] + [None] * len(broken)


def test_times_out_of_range_are_not_dates(spark):
    step = {"op": "to_date", "format": "%Y-%m-%d %H:%M"}
    assert clean_with(spark, "string", ["2024-01-05 24:00", "2024-01-05 10:60", "2024-01-05 10:59"], step) == [
        None, None, dt.date(2024, 1, 5),
    ]


def test_two_digit_years(spark):
    step = {"op": "to_date", "format": "%d/%m/%y"}
    assert clean_with(spark, "string", ["05/01/68", "05/01/69", "29/02/96"], step) == [
        dt.date(2068, 1, 5), dt.date(1969, 1, 5), dt.date(1996, 2, 29),
    ]


def test_to_datetime(spark):
    assert clean_with(spark, "string", ["2024-01-05 10:20:30", "2024-01-05", None], {"op": "to_datetime"}) == [
        dt.datetime(2024, 1, 5, 10, 20, 30), None, None,
    ]
    step = {"op": "to_datetime", "format": "%d/%m/%Y %I:%M %p%.f"}
    assert clean_with(spark, "string", ["05/01/2024 01:30 PM.123456"], step) == [
        dt.datetime(2024, 1, 5, 13, 30, 0, 123000)
    ]
    with pytest.raises(ContractError):
        clean_with(spark, "string", ["x"], {"op": "to_datetime", "unit": "min"})


def test_to_datetime_keeps_a_missing_hour(spark, saving_zone):
    assert clean_with(spark, "string", ["2018-11-04 00:30:00"], {"op": "to_datetime"}) == [
        dt.datetime(2018, 11, 4, 0, 30)
    ]


def test_coalesce(spark):
    assert clean_with(spark, "string", [None, "a"], {"op": "coalesce", "value": 0}) == ["0", "a"]
    assert clean_with(spark, "int", [None, 1], {"op": "coalesce", "value": 0}) == [0, 1]
    assert clean_with(spark, "int", [None, 1], {"op": "coalesce", "value": 0.5}) == [0.5, 1.0]
    assert clean_with(spark, "int", [None, 1], {"op": "coalesce", "value": "none"}) == ["none", "1"]
    assert clean_with(spark, "int", [None, 1], {"op": "coalesce", "value": 2**40}) == [2**40, 1]
    assert clean_with(spark, "boolean", [None, True], {"op": "coalesce", "value": False}) == [False, True]
    with pytest.raises(ContractError):
        clean_with(spark, "string", ["a"], {"op": "coalesce"})


def test_replace_is_a_regular_expression(spark):
    assert clean_with(spark, "string", ["a.b", "axb"], {"op": "replace", "old": "a.b", "new": " - "}) == ["-", "-"]
    assert clean_with(spark, "string", ["a.b"], {"op": "replace", "old": r"\."}) == ["ab"]


@pytest.mark.parametrize("step", [{"op": "replace", "old": "  "}, {"op": "lpad"}, {"op": "capitalize"}])
def test_unsupported_steps_fail_before_any_job(spark, step):
    with pytest.raises(ContractError):
        clean_with(spark, "string", ["a"], step)


def test_steps_on_absent_fields_are_skipped(spark):
    rules = parse_rules({"fields": {"other": {"normalize": [{"op": "capitalize"}]}}}).cleanups
    assert values(clean(frame(spark, "string", ["a"]), rules).frame) == ["a"]


def test_digits_only(spark):
    assert clean_with(spark, "string", ["1.2-3x", "١", None], {"op": "digits_only"}) == ["123", "", None]


def test_lpad_never_cuts(spark):
    assert clean_with(spark, "string", ["1", "123", "12345", None], {"op": "lpad", "len": 3}) == [
        "001", "123", "12345", None,
    ]
    assert clean_with(spark, "string", ["1"], {"op": "lpad", "len": "3", "char": "ab"}) == ["aa1"]


def test_steps_chain_in_order(spark):
    steps = [{"op": "trim"}, {"op": "digits_only"}, {"op": "lpad", "len": 4}]
    assert clean_with(spark, "string", [" 1-2 "], *steps) == ["0012"]


def test_conditions_read_values_before_any_step(spark):
    df = spark.createDataFrame([(1, " x ", "a"), (2, "y", "b"), (3, None, "c")], "k int, flag string, v string")
    when = {"field": "flag", "op": "eq", "value": " x "}
    rules = {"flag": {"normalize": [{"op": "trim"}]}, "v": {"normalize": [{"op": "upper", "when": when}]}}
    got = clean(df, parse_rules({"fields": rules}).cleanups).frame
    assert values(got, "flag") == ["x", "y", None]
    assert values(got) == ["A", "b", "c"]


def test_conditional_step_that_changes_the_type(spark):
    when = {"field": "k", "op": "eq", "value": 0}
    given_dates = ["2024-01-05", "2024-01-06", "x"]
    assert clean_with(spark, "string", given_dates, {"op": "to_date", "when": when}) == given_dates
    assert clean_with(spark, "int", [1, 2], {"op": "lpad", "len": 3, "when": when}) == ["001", "2"]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=12), min_size=40, max_size=60))
def test_repeating_a_step_changes_nothing(spark, texts):
    steps = [{"op": "trim"}, {"op": "upper"}, {"op": "lower"}, {"op": "digits_only"}, {"op": "lpad", "len": 6}]
    rules = parse_rules({"fields": {s["op"]: {"normalize": [s]} for s in steps}}).cleanups
    df = spark.createDataFrame([(t,) * len(steps) for t in texts], [s["op"] for s in steps]).coalesce(1)
    once = clean(df, rules).frame
    rows = once.select(*[F.col(n).alias(f"{n}_once") for n in once.columns], *once.columns)
    for row in clean(rows, rules).frame.collect():
        assert all(row[s["op"]] == row[s["op"] + "_once"] for s in steps)


def test_names_with_dots_and_blanks(spark):
    df = frame(spark, "string", [" a "], name="my.col umn")
    rules = parse_rules({"fields": {"my.col umn": {"normalize": [{"op": "trim"}]}}}).cleanups
    assert values(clean(df, rules).frame, "my.col umn") == ["a"]
