"""The gate counts rows while they are written, and tells what the cast has lost."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluicegate import Contract, LoadContext, run_load
from sluicegate.operators import report, schema
from sluicegate.sources import slices

PARTITIONS = [
    {"name": "tc", "source": "tc", "from": "ctx"},
    {"name": "ano", "source": "ano", "from": "ctx"},
    {"name": "code", "source": "code", "from": "dataframe"},
]
FIELDS = [("k", "int64"), ("amount", "decimal128(10,2)"), ("day", "date32"), ("small", "uint8"), ("code", "string")]
CONTRACT = Contract.from_dicts(
    "sales",
    "v1",
    {"fields": [{"name": n, "type": t} for n, t in FIELDS]},
    {
        "fields": {
            "k": {"validate": [{"rule": "required"}]},
            "amount": {"normalize": [{"op": "trim"}], "validate": [{"rule": "max", "value": 100, "level": "warning"}]},
        },
        "partitioning": {"style": "hive", "fields": PARTITIONS},
    },
)
ROWS = [
    (1, " 10 ", "2024-01-01", 1, "a"), (2, "12x", "2024-02-30", 256, "a"), (3, None, "", -1, "b"), (4, "1e3", None, None, "b"),
    (5, "99999999999", "2024-1-1", 255, "c"),
]


@pytest.fixture
def source(spark, tmp_path):
    def make(rows=ROWS):
        path = str(tmp_path / f"source{len(list(tmp_path.iterdir()))}")
        spark.createDataFrame(rows, "k int, amount string, day string, small int, code string").write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture
def load(tmp_path):
    def run(rows, **options):
        ctx = LoadContext.of(CONTRACT, 2024, "ab")
        return run_load(rows, CONTRACT, ctx, str(tmp_path / "out"), str(tmp_path / "store"), **options)

    return run


@pytest.fixture
def plans(spark):
    """Plans of the SQL executions since the fixture was made, as text."""
    store = spark._jsparkSession.sharedState().statusStore()
    known = store.executionsCount()

    def read():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        listed = store.executionsList()
        new = [listed.apply(i) for i in range(known, listed.size())]
        return [e.physicalPlanDescription() for e in new]

    return read


def test_a_clean_load_reads_its_source_once_and_its_files_never(spark, tmp_path, load, source, plans):
    rows = source([(n, str(n), "2024-01-01", 7, f"c{n % 3}") for n in range(50)])
    result = load(rows)
    assert (result.status, result.rows_total, result.rows_warning) == (report.PUBLISHED, 50, 0)
    read = plans()
    assert sum("Location: InMemoryFileIndex" in text for text in read) == 1
    held = slices.read_slice(spark, str(tmp_path / "store"), CONTRACT, tc="ab", ano=2024)
    assert held.count() == 50 and held.columns == ["k", "amount", "day", "small", "tc", "ano", "code"]


@pytest.mark.parametrize("stable_source", [False, True])
def test_lost_values_are_counted_and_told(load, source, stable_source):
    result = load(source(), stable_source=stable_source)
    assert result.status == report.PUBLISHED
    assert result.cast_losses == {"amount": 2, "day": 3, "small": 2}
    assert "2 values of 'amount' could not be cast and are null" in result.notes
    assert result.rule_hits == {"warning:max:amount": 1} and result.warning_samples_count == 1
    assert load(source(ROWS[:1])).cast_losses == {}


def test_counts_are_those_of_the_written_rows(spark, tmp_path, load):
    """A source that gives other rows on every read, although it is said to be stable."""
    rows = spark.range(2000, numPartitions=4).select(
        F.col("id").cast("int").alias("k"), (F.rand() * 200).cast("string").alias("amount"), F.lit("2024-01-01").alias("day"),
        F.lit(1).alias("small"), F.lit("a").alias("code"),
    )
    result = load(rows, stable_source=True)
    held = slices.read_slice(spark, str(tmp_path / "store"), CONTRACT, tc="ab", ano=2024)
    assert result.rows_warning == held.where("amount > 100").count()
    assert json.loads(Path(result.warning_samples).read_text())["rows_matched_processed"] == result.rows_warning


def test_a_source_that_gets_errors_between_two_reads_is_not_published(spark, tmp_path, load):
    flaky = F.when(F.rand() < 0.99, F.col("id").cast("int"))
    rows = spark.range(400).select(
        flaky.alias("k"), F.lit("1").alias("amount"), F.lit("2024-01-01").alias("day"), F.lit(1).alias("small"), F.lit("a").alias("code")
    )
    result = load(rows, stable_source=True)
    assert result.status == report.INVALID_NOT_PUBLISHED and result.rows_invalid > 0
    assert not list((tmp_path / "out").rglob("*.parquet")) and not (tmp_path / "store").exists()


def test_missing_partition_values_and_foreign_scopes_are_seen_while_writing(spark, tmp_path):
    fields = [{"name": "k", "type": "int64"}, {"name": "ano", "type": "int32"}, {"name": "code", "type": "string"}]
    contract = Contract.from_dicts("s", "v1", {"fields": fields}, {"fields": {"k": {}}, "partitioning": {"style": "hive", "fields": PARTITIONS}})
    rows = spark.createDataFrame([(1, 2024, "x"), (2, 2023, "x"), (3, None, "y")], "k int, ano int, code string")
    result = run_load(rows, contract, LoadContext.of(contract, 2024, "ab"), str(tmp_path), str(tmp_path / "s"))
    assert result.context_mismatches == {"ano": 2} and result.cast_losses == {}


def test_marks_of_many_columns(spark):
    """More columns than one whole number has bits."""
    names = [f"c{n}" for n in range(150)]
    df = spark.createDataFrame([tuple("x" if (n + r) % 3 else "1" for n in range(150)) for r in range(4)], names)
    found = {r.field: r.rows_lost for r in schema.cast_losses(df, [{"name": n, "type": "int32"} for n in names]).collect()}
    assert found == {f"c{n}": sum((n + r) % 3 != 0 for r in range(4)) for n in range(150)}
    done = schema.enforce_marked(df, [{"name": n, "type": "int32"} for n in names])
    assert len(done.marks) == 3 and done.frame.columns == names


def test_only_casts_that_can_lose_are_marked(spark):
    df = spark.createDataFrame([(1, 2.5, "a", bytearray(b"\xff"))], "i int, d double, s string, b binary")
    fields = [{"name": "i", "type": "int64"}, {"name": "d", "type": "int32"}, {"name": "s", "type": "string"}, {"name": "b", "type": "string"}]
    assert sorted(map(tuple, schema.cast_losses(df, fields).collect())) == [("b", 1), ("d", 0)]
    assert schema.cast_losses(df, fields[:1]).collect() == []


def test_a_slice_is_listed_once(spark, tmp_path, load, source):
    """Beside one file whose schema is read, every file of the slice is met once."""
    load(source([(n, str(n), "2024-01-01", 7, f"c{n % 7}") for n in range(50)]))
    held = list((tmp_path / "store/sales/v1/data").rglob("*.parquet"))
    counter = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    before = counter.getCount()
    slices.read_slice(spark, str(tmp_path / "store"), CONTRACT, tc="ab", ano=2024)
    assert len(held) == 7 and counter.getCount() - before == 7 + 1


def test_a_partition_column_in_another_case_is_the_same_to_the_session(spark, tmp_path):
    fields = [{"name": "k", "type": "int64"}, {"name": "Code", "type": "string"}]
    contract = Contract.from_dicts("s", "v1", {"fields": fields}, {"fields": {"k": {}}, "partitioning": {"style": "hive", "fields": PARTITIONS}})
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "k int, Code string")
    result = run_load(rows, contract, LoadContext.of(contract, 2024, "ab"), str(tmp_path), str(tmp_path / "s"))
    assert result.status == report.PUBLISHED
    held = slices.read_slice(spark, str(tmp_path / "s"), contract, tc="ab", ano=2024)
    assert sorted((r.k, r.code) for r in held.collect()) == [(1, "x"), (2, "y")]


def test_a_load_without_adaptive_execution(spark, tmp_path, load, source):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        result = load(source([(n, "12x" if n % 5 == 0 else str(n), "2024-01-01", 7, "hot" if n % 4 else f"c{n % 3}") for n in range(400)]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert (result.status, result.rows_total, result.cast_losses) == (report.PUBLISHED, 400, {"amount": 80})
    held = slices.read_slice(spark, str(tmp_path / "store"), CONTRACT, tc="ab", ano=2024)
    assert held.count() == 400 and held.where("code = 'hot'").count() == 300 and "__first__" not in held.columns
