import datetime as dt
from decimal import Decimal

import pytest
from frames import cast_to
from pyspark.sql import types as T

from sluicegate.functions.casts import Target, parse_token

DAY = dt.date(2024, 1, 5)
TIME = dt.datetime(2024, 1, 5, 10, 20, 30, 123456)


@pytest.mark.parametrize(
    ("token", "expected"),
    [
        (" Int64 ", T.LongType()),
        ({"type": "int8"}, T.ByteType()),
        ("decimal128(18,2)", T.DecimalType(18, 2)),
        ("decimal128(18, 2)", T.StringType()),
        ("timestamp[us, tz=UTC]", T.TimestampNTZType()),
        ("date32", T.DateType()),
        ("double", T.StringType()),
        ("list<float>", T.StringType()),
        (None, T.StringType()),
        (7, T.StringType()),
    ],
)
def test_tokens(token, expected):
    assert parse_token(token).dtype == expected


def test_unsigned_tokens_carry_their_width():
    assert parse_token("uint64") == Target(T.DecimalType(20, 0), 64)


def test_text_to_integer(spark):
    given = ["12", "+12", "-3", " 12 ", "12.5", "1e5", "1_000", "", "99999999999999999999", "١", "12\n", None]
    assert cast_to(spark, "string", given, "int64") == [12, 12, -3] + [None] * 9


def test_text_to_double(spark):
    given = ["12", "1.5", ".5", "5.", "1e5", "-2E-1", "inf", "-Infinity", " 12 ", "1.0d", "1f", "1_000", "", None]
    assert cast_to(spark, "string", given, "float64") == [
        12.0, 1.5, 0.5, 5.0, 1e5, -0.2, float("inf"), float("-inf"), None, None, None, None, None, None,
    ]
    assert str(cast_to(spark, "string", ["NaN"], "float64")[0]) == "nan"


def test_text_to_decimal(spark):
    given = ["12.5", "-1", "12,5", " 1", "abc", "12345678901234567.1", None]
    got = cast_to(spark, "string", given, "decimal128(18,2)")
    assert got == [Decimal("12.50"), Decimal("-1.00"), None, None, None, None, None]


def test_double_to_integer_cuts_and_checks_range(spark):
    assert cast_to(spark, "double", [12.7, -12.7, 1e20, float("nan"), None], "int32") == [12, -12, None, None, None]


def test_integer_to_smaller_integer(spark):
    assert cast_to(spark, "bigint", [127, 128, -129, None], "int8") == [127, None, None, None]


@pytest.mark.parametrize(("token", "limit"), [("uint8", 255), ("uint16", 65535), ("uint32", 4294967295)])
def test_unsigned_range(spark, token, limit):
    assert cast_to(spark, "bigint", [-1, 0, limit, limit + 1, None], token) == [None, 0, limit, None, None]


def test_widest_unsigned(spark):
    top = str(2**64 - 1)
    assert cast_to(spark, "string", [top, str(2**64), "-1", "1.5", "7"], "uint64") == [
        Decimal(top), None, None, None, Decimal(7),
    ]
    assert cast_to(spark, "double", [12.7, -0.5, -1.0], "uint64") == [Decimal(12), Decimal(0), None]


def test_booleans(spark):
    assert cast_to(spark, "string", ["true", "FALSE", "yes", "t", "1", "", None], "bool") == [
        True, False, None, None, None, None, None,
    ]
    assert cast_to(spark, "int", [0, 1, -2, None], "boolean") == [False, True, True, None]
    assert cast_to(spark, "boolean", [True, False], "int32") == [1, 0]
    assert cast_to(spark, "boolean", [True, False], "string") == ["true", "false"]


def test_text_to_date(spark):
    given = ["2024-01-05", "2024-1-5", "2024", "2024-02-30", "05/01/2024", "2024-01-05 x", " 2024-01-05", "", None]
    assert cast_to(spark, "string", given, "date32") == [DAY] + [None] * 8


def test_dates_and_numbers(spark):
    assert cast_to(spark, "int", [19727, None], "date") == [DAY, None]
    assert cast_to(spark, "date", [DAY], "int64") == [19727]
    assert cast_to(spark, "date", [DAY], "timestamp[ms]") == [dt.datetime(2024, 1, 5)]
    assert cast_to(spark, "timestamp_ntz", [TIME], "date32") == [DAY]


def test_timestamps_are_cut_to_milliseconds(spark):
    cut = TIME.replace(microsecond=123000)
    assert cast_to(spark, "timestamp_ntz", [TIME, None], "timestamp[us]") == [cut, None]
    given = ["2024-01-05T10:20:30.123456", "2024-01-05 10:20:30", "2024-01-05T10:20:30+03:00", "2024-01-05", "x", ""]
    whole = TIME.replace(microsecond=0)
    assert cast_to(spark, "string", given, "timestamp") == [cut, whole, whole, None, None, None]
    assert cast_to(spark, "bigint", [1704450030123, 10**18, None], "timestamp") == [cut, None, None]


def test_timestamps_keep_their_wall_time(spark, saving_zone):
    missing_hour = dt.datetime(2018, 11, 4, 0, 30, 0, 123456)
    kept = missing_hour.replace(microsecond=123000)
    assert cast_to(spark, "timestamp_ntz", [missing_hour], "timestamp") == [kept]
    assert cast_to(spark, "timestamp_ntz", [missing_hour], "string") == ["2018-11-04 00:30:00.123456"]
    assert cast_to(spark, "timestamp_ntz", [missing_hour], "string", digits=3) == ["2018-11-04 00:30:00.123"]


def test_timestamp_text_has_fixed_width(spark):
    assert cast_to(spark, "timestamp_ntz", [dt.datetime(2024, 1, 5, 10)], "utf8") == ["2024-01-05 10:00:00.000000"]


def test_timestamp_ticks(spark):
    assert cast_to(spark, "timestamp_ntz", [TIME], "int64") == [1704450030123456]
    assert cast_to(spark, "timestamp_ntz", [TIME], "int64", digits=3) == [1704450030123]


def test_double_text(spark):
    given = [1.0, -0.0, 0.001, 12345678.9, 1e15, 1e16, 1.5e20, 1e-4, 1.2345678901234567e-5, 1e-6, -1e7, 123456789012345.6]
    assert cast_to(spark, "double", given, "string") == [
        "1.0", "-0.0", "0.001", "12345678.9", "1000000000000000.0", "1e16", "1.5e20", "0.0001",
        "0.000012345678901234568", "1e-6", "-10000000.0", "123456789012345.6",
    ]
    special = [float("nan"), float("inf"), float("-inf"), None]
    assert cast_to(spark, "double", special, "string") == ["NaN", "inf", "-inf", None]


def test_float_text(spark):
    given = [1e-4, 1e7, 2.0**44, 0.5]
    assert cast_to(spark, "float", given, "string") == ["0.0001", "10000000.0", "1.7592186e13", "0.5"]


def test_bytes_and_decimals_as_text(spark):
    assert cast_to(spark, "binary", [b"\xc3\xa9", b"\xe9"], "string") == ["é", None]
    assert cast_to(spark, "decimal(18,2)", [Decimal("12.5")], "string") == ["12.50"]
    assert cast_to(spark, "decimal(18,2)", [Decimal("12.5")], "int32") == [12]
