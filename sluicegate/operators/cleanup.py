"""Apply clean-up rules: one projection over the original columns."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from sluicegate.errors import ContractError
from sluicegate.functions.cleanups import OPERATIONS, choose
from sluicegate.functions.operand import Operand, Scope
from sluicegate.functions.predicates import condition, is_usable
from sluicegate.rules import Rule

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class CleanedFrame:
    frame: DataFrame
    millis: list[str]  # columns parsed to millisecond timestamps
    notes: tuple[str, ...] = ()  # operations that run without their condition


def clean(df: DataFrame, rules: Sequence[Rule]) -> CleanedFrame:
    """Chain the operations of each field, all fields in one ``withColumns``.

    Every expression, conditions included, reads the values before any clean-up.
    """
    scope = Scope(df.schema)
    results: dict[str, Operand] = {}
    notes: list[str] = []
    for rule in rules:
        if rule.field is None or rule.field == "*":
            continue
        if rule.field not in scope:
            log.info("clean-up '%s' skipped: no column '%s'", rule.name, rule.field)
            continue
        if rule.when and not is_usable(rule.when):
            notes.append(f"{rule.name} on {rule.field} runs on every row: its condition cannot be read: {dict(rule.when)}")
        current = results.get(rule.field) or scope.get(rule.field, rule.key)
        results[rule.field] = _step(current, rule, scope)
    if not results:
        return CleanedFrame(df, [])
    frame = df.withColumns({name: x.col for name, x in results.items()})
    return CleanedFrame(frame, [name for name, x in results.items() if x.digits == 3], tuple(notes))


def _step(current: Operand, rule: Rule, scope: Scope) -> Operand:
    operation = OPERATIONS.get(rule.name)
    cleaned = operation(current, rule.args) if operation else None
    if cleaned is None:
        raise ContractError(f"clean-up '{rule.name}' on '{rule.field}' is not supported: {dict(rule.args)}")
    applies = condition(rule.when, scope, f"{rule.name}:{rule.field}")
    return cleaned if applies is None else choose(applies, cleaned, current)
