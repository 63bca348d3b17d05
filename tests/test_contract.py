import json

import pytest

from sluicegate.contract import Contract, load_contract
from sluicegate.errors import ContractError
from sluicegate.partitioning import PartitionSpec, escape_path
from sluicegate.rules import parse_rules

PARTITIONING = {"style": "hive", "fields": [{"name": "tc", "source": "tc", "from": "ctx"}]}
SCHEMA = {"fields": [{"name": "a", "type": "string"}, {"name": "b", "type": "int32", "nullable": False}]}


def contract(schema=SCHEMA, partitioning=PARTITIONING, **rules):
    document = {"fields": {"a": {}, "b": {"validate": [{"rule": "required"}]}}, "partitioning": partitioning}
    return Contract.from_dicts("d", "v1", schema, {**document, **rules})


def found(c):
    return [(i.level, i.where) for i in c.check()]


def test_a_sound_contract_has_no_issues():
    assert found(contract()) == []


def test_identity():
    c = contract(schema={**SCHEMA, "dataset": "other", "version": " v1 "}, version="v2")
    assert found(c) == [("ERROR", "schema.arrow.dataset"), ("ERROR", "ingest_rules.json.version")]


def test_fields_must_exist_and_be_well_formed():
    fields = {
        "zz": {},
        "a": {"normalize": {}, "validate": ["x", {"rule": "shape"}, {"rule": "min", "level": "fatal"}]},
        "b": [],
    }
    assert found(contract(fields=fields)) == [
        ("ERROR", "ingest_rules.json.fields.zz"),
        ("ERROR", "ingest_rules.json.fields.a.normalize"),
        ("ERROR", "ingest_rules.json.fields.a.validate[0]"),
        ("WARNING", "ingest_rules.json.fields.a.validate[1]"),
        ("ERROR", "ingest_rules.json.fields.a.validate[2].level"),
        ("ERROR", "ingest_rules.json.fields.b"),
        ("WARNING", "schema.arrow.fields.b.nullable"),
    ]
    assert ("ERROR", "ingest_rules.json.fields") in found(contract(fields={}))
    assert ("ERROR", "schema.arrow.fields") in found(contract(schema={}))


def test_row_checks():
    rows = [{"rule": "required", "field": "zz"}, 1, {"rule": "shape"}, {"rule": "min", "field": "*", "level": "x"}]
    assert found(contract(validations=rows)) == [
        ("ERROR", "ingest_rules.json.validations[1]"),
        ("WARNING", "ingest_rules.json.validations[2]"),
        ("ERROR", "ingest_rules.json.validations[3].level"),
        ("ERROR", "ingest_rules.json.validations[0].field"),
    ]


@pytest.mark.parametrize(
    "partitioning",
    [None, {"style": "hive"}, {"style": "hive", "fields": []}, {"style": " ", "fields": PARTITIONING["fields"]}],
)
def test_partitioning_is_required(partitioning):
    with pytest.raises(ContractError, match="partitioning"):
        contract(partitioning=partitioning).require_sound()


@pytest.mark.parametrize(
    "fields",
    [
        ["tc"],
        [{"name": "", "source": "tc"}],
        [{"name": "tc", "source": ""}],
        [{"name": "tc", "source": "tc", "from": "moon"}],
        [{"name": "mes", "source": "mes"}, {"name": "tc", "source": "tc", "from": "ctx"}],
    ],
)
def test_bad_partition_fields(fields):
    with pytest.raises(ContractError):
        PartitionSpec.parse({"fields": fields})


def test_identity_is_required():
    for dataset, version in ((" ", "v1"), ("d", "")):
        with pytest.raises(ContractError):
            Contract.from_dicts(dataset, version, {}, {})


def test_rules_take_inline_and_nested_arguments():
    item = {"rule": " MIN ", "value": 1, "args": {"value": 2, "extra": 3}, "level": "fatal", "_comment": "x"}
    rule = parse_rules({"fields": {"a": {"validate": [item]}}}).checks[0]
    assert (rule.name, dict(rule.args), rule.level, rule.key, rule.comment) == (
        "min", {"value": 2, "extra": 3}, "error", "error:min:a", "x",
    )


def test_rules_that_are_switched_off_or_nameless_are_dropped():
    items = [{"rule": "min", "enabled": False}, {"value": 1}, "min", {"op": "max"}, {"rule": "gt", "enabled": "false"}]
    parsed = parse_rules({"fields": {"a": {"validate": items}, "b": "no block"}})
    assert [r.name for r in parsed.checks] == ["max", "gt"]


def test_rule_lists_must_be_lists():
    for document in ({}, {"fields": {"a": {"validate": {"rule": "min"}}}}, {"fields": {}, "validations": "x"}):
        with pytest.raises(ContractError):
            parse_rules(document)


def test_scope_paths():
    spec = PartitionSpec.parse(
        {
            "fields": [
                {"name": "tc", "source": "tc", "from": "ctx"},
                {"name": "ano", "source": "year", "from": "ctx"},
                {"name": "mes", "source": "month"},
            ]
        }
    )
    assert spec.scope_path({"tc": "a/b:c d", "ano": 2024}) == "tc=a%2Fb%3Ac d/ano=2024"
    assert spec.scope_path({"tc": "x"}, depth=1) == "tc=x"
    assert spec.depth_through("ano") == 2
    for values in ({"tc": " ", "ano": 1}, {"tc": None, "ano": 1}, {"tc": "x"}):
        with pytest.raises(ContractError):
            spec.scope_path(values)
    with pytest.raises(ContractError):
        spec.depth_through("dia")
    no_scope = PartitionSpec.parse({"fields": [{"name": "mes", "source": "mes"}]})
    with pytest.raises(ContractError):
        no_scope.scope_path({})


def test_escaping_is_the_one_spark_uses(spark, tmp_path):
    names = ["a b", "a/b:c", 'q"#%\'*=?\\{[]^}', "tab\t~é", "x\x7fy"]
    path = str(tmp_path / "t")
    spark.createDataFrame([(n, 1) for n in names], "n string, v int").write.partitionBy("n").parquet(path)
    written = {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()}
    assert written == {f"n={escape_path(n)}" for n in names}


def test_contracts_are_read_from_the_store(spark, tmp_path):
    folder = tmp_path / "d" / "v1" / "contract"
    folder.mkdir(parents=True)
    c = contract()
    (folder / "schema.arrow").write_text(json.dumps(c.schema, indent=2))
    (folder / "ingest_rules.json").write_text(json.dumps(c.rules, indent=2))
    assert load_contract(spark, str(tmp_path), " D ", "V1") == c
    (folder / "ingest_rules.json").write_text(json.dumps({**c.rules, "fields": {}}))
    with pytest.raises(ContractError):
        load_contract(spark, str(tmp_path), "d", "v1")
