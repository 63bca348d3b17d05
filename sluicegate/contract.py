"""A contract: the schema document and the rules document of one dataset version."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import SparkSession

from sluicegate.errors import ContractError
from sluicegate.functions.checks import DOCUMENT_CHECK, FIELD_CHECKS
from sluicegate.functions.cleanups import OPERATIONS
from sluicegate.partitioning import PartitionSpec
from sluicegate.rules import ALIASES, ERROR, WARNING, RuleSet, parse_rules, rule_name

# File names of the two documents.
SCHEMA_FILE = "schema.arrow"
RULES_FILE = "ingest_rules.json"

KNOWN_CHECKS = {*FIELD_CHECKS, *ALIASES, DOCUMENT_CHECK}


@dataclass(frozen=True)
class Issue:
    level: str  # ERROR or WARNING
    where: str
    message: str


@dataclass(frozen=True)
class Contract:
    dataset: str
    version: str
    schema: Mapping[str, Any]
    rules: Mapping[str, Any]

    @classmethod
    def from_dicts(
        cls, dataset: str, version: str, schema: Mapping[str, Any], rules: Mapping[str, Any]
    ) -> Contract:
        dataset, version = (dataset or "").strip(), (version or "").strip()
        if not dataset or not version:
            raise ContractError("a contract needs a dataset and a version")
        if not isinstance(schema, Mapping) or not isinstance(rules, Mapping):
            raise ContractError("both contract documents must be objects")
        return cls(dataset, version, schema, rules)

    @property
    def fields(self) -> list[Mapping[str, Any]]:
        """Schema fields that have a name, without blanks around it."""
        fields = self.schema.get("fields")
        if not isinstance(fields, list):
            return []
        named = [f for f in fields if isinstance(f, Mapping) and str(f.get("name") or "").strip()]
        return [{**f, "name": str(f["name"]).strip()} for f in named]

    @property
    def field_names(self) -> list[str]:
        return [f["name"] for f in self.fields]

    @property
    def rule_set(self) -> RuleSet:
        return parse_rules(self.rules)

    @property
    def partitioning(self) -> PartitionSpec:
        return PartitionSpec.parse(self.rules.get("partitioning"))

    def check(self) -> list[Issue]:
        """What is wrong with the documents: every place in them against the preconditions for its kind."""
        return [
            Issue(p.level, f"{place.where}{p.at}", told)
            for place in _places(self)
            for p in PRECONDITIONS
            if p.kind == place.kind and (told := p.fault(place, self))
        ]

    def require_sound(self) -> Contract:
        errors = [i for i in self.check() if i.level == "ERROR"]
        if errors:
            told = "; ".join(f"{i.where}: {i.message}" for i in errors)
            raise ContractError(f"contract {self.dataset}/{self.version}: {told}")
        return self


def load_contract(spark: SparkSession, root: str, dataset: str, version: str) -> Contract:
    """Read and check ``<root>/<dataset>/<version>/contract/`` from any Hadoop file system."""
    dataset, version = dataset.strip().lower(), version.strip().lower()
    base = f"{root.rstrip('/')}/{dataset}/{version}/contract"
    contract = Contract.from_dicts(
        dataset,
        version,
        _read_json(spark, f"{base}/{SCHEMA_FILE}"),
        _read_json(spark, f"{base}/{RULES_FILE}"),
    )
    return contract.require_sound()


def _read_json(spark: SparkSession, path: str) -> Any:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


@dataclass(frozen=True)
class Place:
    """One place in the documents: what it is, where it is, and what stands there."""

    kind: str
    where: str
    value: Any


# Lists of rules in a field's block, with the key that names a rule there and the names that are known.
FIELD_LISTS = {"normalize": ("op", frozenset(OPERATIONS)), "validate": ("rule", frozenset(KNOWN_CHECKS))}


def _places(contract: Contract) -> Iterator[Place]:
    """All places that preconditions are about; nothing below a place that is not what it must be."""
    for file, document in ((SCHEMA_FILE, contract.schema), (RULES_FILE, contract.rules)):
        yield Place("dataset", f"{file}.dataset", document.get("dataset"))
        yield Place("version", f"{file}.version", document.get("version"))
    yield Place("columns", f"{SCHEMA_FILE}.fields", contract.fields)
    blocks = contract.rules.get("fields")
    yield Place("blocks", f"{RULES_FILE}.fields", blocks)
    blocks = blocks if isinstance(blocks, Mapping) else {}
    for name, block in blocks.items():
        yield Place("block", f"{RULES_FILE}.fields.{name}", (name, block))
        for key in FIELD_LISTS if isinstance(block, Mapping) else ():
            yield from _rule_places(block.get(key), f"{RULES_FILE}.fields.{name}.{key}", key)
    for field in contract.fields:
        yield Place("column", f"{SCHEMA_FILE}.fields.{field['name']}", (field, blocks.get(field["name"])))
    rules = contract.rules.get("validations")
    yield from _rule_places(rules, f"{RULES_FILE}.validations", "row")
    for at, rule in enumerate(rules if isinstance(rules, list) else []):
        yield Place("target", f"{RULES_FILE}.validations[{at}]", rule if isinstance(rule, Mapping) else {})
    yield Place("partitioning", f"{RULES_FILE}.partitioning", contract.rules.get("partitioning"))


def _rule_places(rules: Any, where: str, kind: str) -> Iterator[Place]:
    yield Place("list", where, rules)
    for at, rule in enumerate(rules if isinstance(rules, list) else []):
        place = Place("rule", f"{where}[{at}]", rule)
        yield place
        if isinstance(rule, Mapping):
            yield replace(place, kind=f"{kind} rule")


@dataclass(frozen=True)
class Precondition:
    """What must hold at places of one kind: ``fault`` says what is wrong, or gives nothing."""

    kind: str
    level: str
    fault: Callable[[Place, Contract], str | None]
    at: str = ""  # the part of the place that is at fault


def _text(value: Any) -> str:
    return str(value or "").strip()


def _is(kind: type, told: str) -> Callable[[Place, Contract], str | None]:
    return lambda place, contract: None if isinstance(place.value, kind) else told


def _same_as(name: str) -> Callable[[Place, Contract], str | None]:
    def fault(place: Place, contract: Contract) -> str | None:
        given, wanted = _text(place.value), getattr(contract, name)
        return f"'{given}' is not '{wanted}'" if given not in ("", wanted) else None

    return fault


def _named_among(key: str, known: frozenset[str]) -> Callable[[Place, Contract], str | None]:
    def fault(place: Place, contract: Contract) -> str | None:
        name = rule_name(place.value, key)
        return f"'{name}' is not supported" if name and name not in known else None

    return fault


def _level(place: Place, contract: Contract) -> str | None:
    level = _text(place.value.get("level") or ERROR).lower()
    return f"'{level}' is not a level" if level not in (ERROR, WARNING) else None


def _own_column(place: Place, contract: Contract) -> str | None:
    field = _text(place.value.get("field"))
    return f"'{field}' is not in the schema" if field not in ("", "*", *contract.field_names) else None


def _requires(rule: Any) -> bool:
    return isinstance(rule, Mapping) and bool(rule.get("enabled", True)) and rule_name(rule, "rule") in REQUIRING


def _checked_for_null(place: Place, contract: Contract) -> str | None:
    field, block = place.value
    rules = block.get("validate") if isinstance(block, Mapping) else None
    if field.get("nullable", True) is not False or any(map(_requires, rules if isinstance(rules, list) else [])):
        return None
    return "is not nullable, but no required rule checks it"


def _partitions(place: Place, contract: Contract) -> str | None:
    if not isinstance(place.value, Mapping):
        return None
    try:
        PartitionSpec.parse(place.value)
    except ContractError as error:
        return str(error)
    return None


# The rules that a column which is not nullable must have one of.
REQUIRING = ("required", "notnull")

PRECONDITIONS = (
    Precondition("dataset", "ERROR", _same_as("dataset")),
    Precondition("version", "ERROR", _same_as("version")),
    Precondition("columns", "ERROR", lambda place, _: None if place.value else "missing or empty"),
    Precondition("blocks", "ERROR", lambda p, _: None if isinstance(p.value, Mapping) and p.value else "must be a non-empty object"),
    Precondition("block", "ERROR", lambda place, contract: None if place.value[0] in contract.field_names else "not in the schema"),
    Precondition("block", "ERROR", lambda place, _: None if isinstance(place.value[1], Mapping) else "must be an object"),
    Precondition("list", "ERROR", _is((list, type(None)), "must be a list")),
    Precondition("rule", "ERROR", _is(Mapping, "must be an object")),
    *(Precondition(f"{kind} rule", "WARNING", _named_among(*known)) for kind, known in FIELD_LISTS.items()),
    Precondition("row rule", "WARNING", _named_among(*FIELD_LISTS["validate"])),
    *(Precondition(f"{kind} rule", "ERROR", _level, ".level") for kind in (*FIELD_LISTS, "row")),
    Precondition("target", "ERROR", _own_column, ".field"),
    Precondition("column", "WARNING", _checked_for_null, ".nullable"),
    Precondition("partitioning", "ERROR", _is(Mapping, "is missing")),
    Precondition("partitioning", "ERROR", lambda p, _: None if not isinstance(p.value, Mapping) or _text(p.value.get("style")) else "is missing", ".style"),
    Precondition("partitioning", "ERROR", _partitions, ".fields"),
)
