"""What the physical plans must and must not hold."""

import pytest
from test_queries import SMALL

import __spark_entry__ as entries
from sluicegate.operators import report
from sluicegate.queries.base import REGISTRY, checked, table
from sluicegate.queries.reports import WIDE_LINES

FORBIDDEN = ("Cartesian", "NestedLoop", "Broadcast", "PythonUDF", "EvalPython", "MapInPandas", "InMemoryTableScan")
LAZY = [n for n in REGISTRY if not n.startswith(("stream_", "publish_", "gate_", "mirror_", "read_"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_query_joins_broadcasts_or_leaves_the_jvm(spark, name):
    text = plan(entries.queries()[name](spark, SMALL))
    assert not [word for word in FORBIDDEN if word in text]


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("val_max", "GreaterThan(o_totalprice,450000.0)"),
        ("val_when", "LessThan(l_discount,0.02)"),
        ("val_in", "Not(In(event_type"),
        ("split_invalid", "GreaterThan(o_totalprice,450000.0)"),
        ("invalid_samples", "GreaterThan(o_totalprice,450000.0)"),
        ("src_year_template", "GreaterThanOrEqual(o_orderdate,1998-01-01"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(entries.queries()[name](spark, SMALL))


def test_checks_read_only_the_columns_of_their_rules(spark):
    text = plan(entries.queries()["val_min"](spark, SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in text


def test_all_counts_come_from_one_scan_and_one_exchange(spark):
    result = checked(table(spark, SMALL, "lineitem"), WIDE_LINES)
    counts = result.frame.agg(*report.row_counts(), *report.hit_counts(result.checks))
    text = plan(counts)
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "l_partkey" not in text[text.index("ReadSchema") :]


def test_ordered_samples_are_merged_before_the_last_task(spark):
    text = plan(entries.queries()["invalid_samples"](spark, SMALL))
    assert text.count("WindowGroupLimit") == 2 and "TakeOrderedAndProject" in text


def test_flags_stay_in_generated_code(spark):
    df = entries.queries()["flags"](spark, SMALL)
    df.collect()
    assert "*(1) Project" in plan(df)


@pytest.mark.parametrize(("value", "pushed"), [(100.5, "GreaterThan(o_orderkey,100)"), (-3, "GreaterThan(o_orderkey,-3)")])
def test_whole_number_limits_reach_the_scan(spark, value, pushed):
    done = checked(table(spark, SMALL, "orders"), {"o_orderkey": [{"rule": "max", "value": value}]})
    assert pushed in plan(done.bad_rows("error"))


@pytest.mark.parametrize(
    ("rule", "value", "pushed"),
    [
        ("max", 100.5, "GreaterThanOrEqual(amount,100.51)"),
        ("max", 100, "GreaterThanOrEqual(amount,100.01)"),
        ("min", -3, "LessThan(amount,-3.00)"),
        ("gt", 0, "LessThan(amount,0.01)"),
    ],
)
def test_decimal_limits_reach_the_scan(spark, tmp_path, rule, value, pushed):
    orders = table(spark, SMALL, "orders").selectExpr("cast(o_totalprice as decimal(18,2)) as amount")
    orders.write.parquet(str(tmp_path / "decimals"))
    done = checked(spark.read.parquet(str(tmp_path / "decimals")), {"amount": [{"rule": rule, "value": value}]})
    assert pushed in plan(done.bad_rows("error"))
    assert "cast(amount" not in plan(done.bad_rows("error"))
