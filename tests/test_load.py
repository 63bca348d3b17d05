import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate import Contract, ContractError, LoadContext, run_load
from sluicegate.operators import report
from sluicegate.plans import transfer
from sluicegate.sinks import files
from sluicegate.sources import slices

SCHEMA = {
    "fields": [
        {"name": "k", "type": "int64"},
        {"name": "name", "type": "string"},
        {"name": "amount", "type": "decimal128(18,2)"},
        {"name": "code", "type": "string"},
    ]
}
RULES = {
    "fields": {
        "k": {"validate": [{"rule": "required"}]},
        "name": {"normalize": [{"op": "trim"}, {"op": "upper"}]},
        "amount": {
            "validate": [
                {"rule": "gt", "value": 0},
                {"rule": "max", "value": 1000, "level": "warning"},
            ]
        },
    },
    "partitioning": {
        "style": "hive",
        "fields": [
            {"name": "tc", "source": "tc", "from": "ctx"},
            {"name": "ano", "source": "ano", "from": "ctx"},
            {"name": "code", "source": "code", "from": "dataframe"},
        ],
    },
}
GOOD = [("1", " a ", "10.5", "007"), ("2", "b", "20", "007"), ("3", "c", "5000", "010")]


@pytest.fixture
def contract():
    return Contract.from_dicts("sales", "v1", SCHEMA, RULES)


@pytest.fixture
def load(spark, contract, tmp_path):
    def run(rows, tc="ab", ano=2024, publish=True, **options):
        source = spark.createDataFrame(rows, "c1 string, c2 string, c3 string, c4 string")
        store = str(tmp_path / "store") if publish else None
        ctx = LoadContext.of(contract, ano, tc)
        return run_load(source, contract, ctx, str(tmp_path / "out"), store, sample_order=["k"], **options)

    return run


@pytest.fixture
def published(spark, contract, tmp_path):
    def read(tc="ab", ano=2024):
        rows = slices.read_slice(spark, str(tmp_path / "store"), contract, tc=tc, ano=ano)
        return sorted((r.k, r.name, str(r.amount), r.code, r.tc, r.ano) for r in rows.collect())

    return read


def _document(path):
    return json.loads(Path(path).read_text(encoding="utf-8"))


@pytest.mark.parametrize("options", [{}, {"stable_source": True}, {"gather": False}])
def test_a_clean_load_is_published(spark, tmp_path, load, published, options):
    result = load(GOOD, **options)
    assert (result.status, result.rows_total, result.rows_valid, result.rows_invalid, result.rows_warning) == (
        report.PUBLISHED, 3, 3, 0, 1,
    )
    assert result.rule_hits == {"warning:max:amount": 1}
    assert published() == [
        (1, "A", "10.50", "007", "ab", 2024),
        (2, "B", "20.00", "007", "ab", 2024),
        (3, "C", "5000.00", "010", "ab", 2024),
    ]
    assert result.staged is None and not files.exists(spark, f"{result.output_dir}/data")
    names = [p.name for p in (tmp_path / "store/sales/v1/data/tc=ab/ano=2024").iterdir() if p.is_dir()]
    assert sorted(names) == ["code=007", "code=010"]


def test_files_are_zstd_parquet(spark, tmp_path, load):
    import pyarrow.parquet as pq

    load(GOOD)
    file = next((tmp_path / "store").rglob("*.parquet"))
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


@pytest.mark.parametrize("stable_source", [False, True])
def test_one_error_changes_nothing(spark, load, published, stable_source):
    load(GOOD)
    before = published()
    bad = [("9", "z", "1", "007"), (None, "y", "-1", "007"), ("8", "w", "abc", "011")]
    result = load(bad, stable_source=stable_source)
    assert (result.status, result.rows_invalid, result.published) == (report.INVALID_NOT_PUBLISHED, 1, None)
    assert published() == before
    assert not files.exists(spark, f"{result.output_dir}/data")
    told = _document(result.invalid_samples)
    row = told["samples"][0]
    assert row["k"] is None and row["amount"] == "-1.00" and row["__sample_seq__"] == 1
    assert [i["rule"] for i in row["__issues__"]] == ["required", "gt"]
    assert told["rows_total_processed"] == 3 and told["kind"] == "invalid" and told["tc"] == "ab"
    assert {s["key"] for s in told["rules_summary"]} == {"error:required:k", "error:gt:amount"}


def test_a_new_load_replaces_its_whole_scope(tmp_path, load, published):
    load(GOOD)
    load(GOOD, tc="abc")
    load(GOOD, ano=2023)
    load([("7", "x", "1", "099")])
    assert published() == [(7, "X", "1.00", "099", "ab", 2024)]
    assert [p.name for p in (tmp_path / "store/sales/v1/_retired").iterdir()] == []
    assert len(published(tc="abc")) == 3 and len(published(ano=2023)) == 3


def test_an_empty_load_clears_nothing(load, published):
    load(GOOD)
    result = load([])
    assert (result.status, result.published) == (report.NO_ROWS, None)
    assert len(published()) == 3


def test_without_publishing_the_snapshot_stays(spark, load):
    result = load(GOOD, publish=False)
    assert result.status == report.VALIDATED_NOT_PUBLISHED
    assert files.has_data(spark, result.staged)
    told = _document(result.warning_samples)
    assert (told["samples_count"], told["truncated"], told["samples"][0]["k"]) == (1, False, 3)


def test_sample_limits(load):
    bad = [(None, "x", "1", "1")] * 5
    result = load(bad, max_samples=2)
    assert (result.invalid_samples_count, result.invalid_samples_truncated) == (2, True)
    assert load(bad, max_samples=0).invalid_samples is None


@pytest.mark.parametrize("stable_source", [False, True])
@pytest.mark.parametrize("value", [None, "", "   "])
def test_rows_without_a_partition_value_stop_the_load(load, value, stable_source):
    with pytest.raises(ContractError, match="partition value"):
        load([*GOOD, ("4", "d", "1", value)], stable_source=stable_source)


def test_errors_come_before_missing_partition_values(load):
    assert load([(None, "d", "1", None)]).status == report.INVALID_NOT_PUBLISHED


def test_wrong_column_count_and_unsound_contracts(spark, contract, tmp_path):
    ctx = LoadContext.of(contract, 2024, "ab")
    with pytest.raises(ContractError, match="columns"):
        run_load(spark.range(1), contract, ctx, str(tmp_path))
    broken = Contract.from_dicts("sales", "v1", SCHEMA, {**RULES, "partitioning": {}})
    with pytest.raises(ContractError, match="partitioning"):
        run_load(spark.range(1), broken, ctx, str(tmp_path))


def test_own_values_that_differ_from_the_scope_are_counted(spark, tmp_path):
    schema = {"fields": [{"name": "k", "type": "int64"}, {"name": "ano", "type": "int32"}]}
    rules = {"fields": {"k": {}}, "partitioning": {"style": "hive", "fields": RULES["partitioning"]["fields"][:2]}}
    contract = Contract.from_dicts("sales", "v1", schema, rules)
    source = spark.createDataFrame([(1, 2024), (2, 2023), (3, None)], "k int, ano int")
    result = run_load(source, contract, LoadContext.of(contract, 2024, "ab"), str(tmp_path), str(tmp_path / "s"))
    assert result.context_mismatches == {"ano": 2} and result.status == report.PUBLISHED


def test_partition_names_may_differ_from_their_columns(spark, tmp_path):
    schema = {"fields": [{"name": "k", "type": "int64"}, {"name": "month", "type": "int32"}]}
    partitions = [
        {"name": "producer", "source": "tc", "from": "ctx"},
        {"name": "mes", "source": "month", "from": "dataframe"},
    ]
    rules = {"fields": {"k": {}}, "partitioning": {"style": "hive", "fields": partitions}}
    contract = Contract.from_dicts("sales", "v1", schema, rules)
    source = spark.createDataFrame([(1, 1), (2, 12)], "k int, m int")
    ctx = LoadContext.of(contract, 2024, "ab")
    run_load(source, contract, ctx, str(tmp_path / "out"), str(tmp_path / "s"))
    rows = slices.read_slice(spark, str(tmp_path / "s"), contract, producer="ab").orderBy("k")
    assert [(r.k, r.month, r.tc, r.producer, r.mes) for r in rows.collect()] == [
        (1, 1, "ab", "ab", 1), (2, 12, "ab", "ab", 12),
    ]


def test_partition_columns_may_have_any_name(spark, tmp_path):
    from sluicegate.partitioning import PartitionSpec
    from sluicegate.sinks.publish import read_scope_files, write_scope

    fields = [{"name": "tc", "source": "tc", "from": "ctx"}, {"name": "the.month of", "source": "the.month of"}]
    spec = PartitionSpec.parse({"fields": fields})
    df = spark.createDataFrame([(1, "a/b"), (2, "01")], ["k", "the.month of"])
    path = write_scope(df, spec, {"tc": "ab"}, str(tmp_path))
    assert sorted(map(tuple, read_scope_files(spark, path, df.schema).collect())) == [(1, "a/b"), (2, "01")]


def test_a_failed_swap_brings_the_old_data_back(spark, load, published, monkeypatch):
    load(GOOD)
    before = published()
    original = files.rename

    def fail(session, source, target):
        if "/out/" in source:
            raise OSError("no space")
        original(session, source, target)

    monkeypatch.setattr(files, "rename", fail)
    with pytest.raises(OSError):
        load([("7", "x", "1", "099")])
    assert published() == before


def test_stores_where_a_rename_copies(spark, load, published, monkeypatch):
    monkeypatch.setattr(files, "renames_in_place", lambda session, source, target: False)
    load(GOOD)
    result = load([("7", "x", "1", "099")])
    assert published() == [(7, "X", "1.00", "099", "ab", 2024)]
    assert not files.has_data(spark, f"{result.output_dir}/data")


def test_hot_partition_is_split_over_tasks(spark, tmp_path):
    """A partition with most rows is written by several tasks."""
    from sluicegate.partitioning import PartitionSpec
    from sluicegate.sinks.publish import write_scope

    spec = PartitionSpec.parse(RULES["partitioning"])
    rows = spark.range(0, 400_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 5)).alias("code"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        path = write_scope(rows, spec, {"tc": "ab", "ano": 1}, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(Path(path, "code=hot").glob("*.parquet"))) > 2
    assert spark.read.parquet(path).count() == 400_000


@pytest.mark.parametrize("hot", [0.5, 0.9])
def test_shares_follow_the_rows_without_adaptive_execution(spark, tmp_path, hot):
    """Files of partitions with many rows are about equal, and no partition is left to one task."""
    import pyarrow.parquet as pq

    from sluicegate.partitioning import PartitionSpec
    from sluicegate.sinks.publish import write_scope

    spec = PartitionSpec.parse(RULES["partitioning"])
    rows = spark.range(0, 120_000, numPartitions=6).select(
        "id",
        F.when(F.col("id") % 100 < 100 * hot, "hot").when(F.col("id") % 1000 == 999, None).otherwise(F.concat(F.lit("c"), F.col("id") % 3)).alias("code"),
        F.create_map(F.lit("a"), F.col("id")).alias("kept"),
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        path = write_scope(rows, spec, {"tc": "ab", "ano": 1}, str(tmp_path))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    sizes = {d.name: [pq.ParquetFile(f).metadata.num_rows for f in d.glob("*.parquet")] for d in Path(path).iterdir() if d.is_dir()}
    assert sum(map(sum, sizes.values())) == 120_000 and len(sizes["code=hot"]) == int(16 * hot + 0.999)
    large = [n for name in sizes if sum(sizes[name]) > 120_000 / 16 for n in sizes[name]]
    assert max(large) <= 2 * min(large) and spark.read.parquet(path).count() == 120_000


def test_slices_are_exact_typed_and_pruned(spark, contract, tmp_path, load):
    load(GOOD)
    load(GOOD, tc="abc")
    load(GOOD, ano=2023)
    root = str(tmp_path / "store")
    rows = slices.read_slice(spark, root, contract, tc="ab", ano=2024)
    assert rows.schema["code"].dataType == T.StringType() and rows.schema["tc"].dataType == T.StringType()
    assert all("/tc=ab/ano=2024/" in f for f in rows.inputFiles())
    assert slices.read_all_years(spark, root, contract, "ab").count() == 6
    with pytest.raises(FileNotFoundError):
        slices.read_slice(spark, root, contract, tc="a", ano=2024)
    with pytest.raises(FileNotFoundError):
        slices.read_all_years(spark, root, contract, "a")


def _store_contract(tmp_path):
    folder = tmp_path / "store/sales/v1/contract"
    folder.mkdir(parents=True)
    (folder / "schema.arrow").write_text(json.dumps(SCHEMA))
    (folder / "ingest_rules.json").write_text(json.dumps(RULES))


def test_export_and_download(spark, tmp_path):
    _store_contract(tmp_path)
    (tmp_path / "sql/sales").mkdir(parents=True)
    (tmp_path / "sql/sales/v1.sql").write_text("select k, name, amount, code from raw_sales where ano = {{ano}};\n")
    raw = [(*row, ano) for ano in (2023, 2024) for row in GOOD]
    kinds = "k string, name string, amount string, code string, ano int"
    spark.createDataFrame(raw, kinds).createOrReplaceTempView("raw_sales")
    roots = {n: str(tmp_path / n) for n in ("sql", "store", "out", "copy", "second")}
    for ano in (2023, 2024):
        result = transfer.export_dataset(
            spark, "Sales", " V1 ", ano, " AB ", roots["sql"], roots["store"], roots["out"]
        )
        assert result.status == report.PUBLISHED and result.rows_total == 3
    dry = transfer.export_dataset(
        spark, "sales", "v1", 2024, "ab", roots["sql"], roots["store"], roots["out"], publish=False
    )
    assert dry.status == report.VALIDATED_NOT_PUBLISHED

    contract = Contract.from_dicts("sales", "v1", SCHEMA, RULES)
    done = transfer.download_slice(spark, roots["store"], "sales", "v1", "AB", 2024, roots["copy"], roots["second"])
    assert [c.removeprefix(str(tmp_path)) for c in done.copies] == [
        "/copy/sales/v1/data/tc=ab/ano=2024", "/second/sales/v1/data/tc=ab/ano=2024",
    ]
    assert (done.tc, done.ano, done.status) == ("ab", 2024, transfer.DOWNLOADED)
    assert slices.read_slice(spark, roots["copy"], contract, tc="ab", ano=2024).count() == 3
    done = transfer.download_all_years(spark, roots["store"], "sales", "v1", "ab", roots["copy"])
    assert (done.ano, done.status) == (None, transfer.DOWNLOADED_ALL_YEARS)
    copied = slices.read_all_years(spark, roots["copy"], contract, "ab")
    kept = slices.read_all_years(spark, roots["store"], contract, "ab")
    assert copied.count() == 6 and copied.exceptAll(kept.select(copied.columns)).count() == 0
    with pytest.raises(FileNotFoundError):
        transfer.download_slice(spark, roots["store"], "sales", "v1", "ab", 1999, roots["copy"])
    with pytest.raises(ValueError):
        transfer.download_slice(spark, roots["store"], "sales", "v1", " ", 2024, roots["copy"])
    with pytest.raises(ValueError):
        transfer.download_slice(spark, roots["store"], "sales", "v1", "ab", 2024)
