"""Rules as a contract declares them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from sluicegate.errors import ContractError

ERROR, WARNING = "error", "warning"

# Arguments that may stand beside the rule name instead of inside "args".
INLINE_ARGS = (
    "value",
    "values",
    "pattern",
    "format",
    "scale",
    "len",
    "char",
    "old",
    "new",
    "unit",
)
ALIASES = {"len_max": "max_length"}


@dataclass(frozen=True)
class Rule:
    name: str
    field: str | None
    args: Mapping[str, Any] = field(default_factory=dict)
    when: Mapping[str, Any] | None = None
    level: str = ERROR
    comment: str | None = None

    @property
    def key(self) -> str:
        return f"{self.level}:{self.name}:{self.field or 'global'}"


@dataclass(frozen=True)
class RuleSet:
    cleanups: tuple[Rule, ...]
    checks: tuple[Rule, ...]


def parse_rules(document: Mapping[str, Any]) -> RuleSet:
    fields = document.get("fields")
    if not isinstance(fields, Mapping):
        raise ContractError("ingest rules: 'fields' must be an object")
    cleanups: list[Rule] = []
    checks: list[Rule] = []
    for name, block in fields.items():
        if isinstance(block, Mapping):
            cleanups += _rules(block, "normalize", "op", str(name))
            checks += _rules(block, "validate", "rule", str(name))
    checks += _rules(document, "validations", "rule", None)
    return RuleSet(tuple(cleanups), tuple(checks))


def rule_name(item: Mapping[str, Any], name_key: str) -> str | None:
    name = next(filter(None, (text_or_none(item.get(k)) for k in (name_key, "rule", "op"))), None)
    return None if name is None else name.lower()


def _rules(block: Mapping[str, Any], part: str, name_key: str, owner: str | None) -> list[Rule]:
    items = block.get(part) or []
    if not isinstance(items, list):
        raise ContractError(f"{owner or 'ingest rules'}: '{part}' must be a list")
    parsed = (_rule(item, name_key, owner) for item in items)
    return [rule for rule in parsed if rule is not None]


def _rule(item: Any, name_key: str, owner: str | None) -> Rule | None:
    if not isinstance(item, Mapping) or not item.get("enabled", True):
        return None
    name = rule_name(item, name_key)
    if name is None:
        return None
    nested = item.get("args") if isinstance(item.get("args"), Mapping) else {}
    level = str(item.get("level") or ERROR).strip().lower()
    return Rule(
        name=ALIASES.get(name, name),
        field=text_or_none(owner if owner is not None else item.get("field")),
        args={**{k: item[k] for k in INLINE_ARGS if k in item}, **nested},
        when=item["when"] if isinstance(item.get("when"), Mapping) else None,
        level=level if level in (ERROR, WARNING) else ERROR,
        comment=text_or_none(item.get("comment")) or text_or_none(item.get("_comment")),
    )


def text_or_none(value: Any) -> str | None:
    return None if value is None else str(value).strip() or None
