"""Flag rows that break rules, and split them by severity."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.errors import ContractError
from sluicegate.functions.checks import DOCUMENT_CHECK, FIELD_CHECKS, document_by_type
from sluicegate.functions.operand import Scope, column
from sluicegate.functions.predicates import condition, is_usable
from sluicegate.names import unused
from sluicegate.rules import ERROR, WARNING, Rule

# Names of the two row marks; the samples never show them.
ROW_INVALID = "__row_invalid__"
ROW_WARNING = "__row_warning__"


@dataclass(frozen=True)
class Check:
    rule: Rule
    flag: str  # column that holds the result
    broken: Column  # true where the rule is broken; may be null where it is not

    @property
    def is_error(self) -> bool:
        return self.rule.level == ERROR


@dataclass(frozen=True)
class CheckPlan:
    checks: tuple[Check, ...]
    notes: tuple[str, ...]  # declared rules that do not run, or run without their condition


def compile_checks(rules: Sequence[Rule], scope: Scope) -> CheckPlan:
    checks: list[Check] = []
    notes: list[str] = []
    for number, rule in enumerate(rules, start=1):
        broken = _broken(rule, scope)
        if broken is None:
            notes.append(f"{rule.key} does not run: unknown rule, no field or missing argument")
            continue
        if rule.when and not is_usable(rule.when):
            notes.append(f"{rule.key} runs on every row: its condition cannot be read: {dict(rule.when)}")
        applies = condition(rule.when, scope, rule.key)
        if applies is not None:
            broken = applies & broken
        checks.append(Check(rule, unused(_flag_name(number, rule), scope.names), broken))
    return CheckPlan(tuple(checks), tuple(notes))


def _broken(rule: Rule, scope: Scope) -> Column | None:
    if rule.field is None:
        return document_by_type(rule.args, scope, rule.key) if rule.name == DOCUMENT_CHECK else None
    if rule.field == "*" or rule.name not in FIELD_CHECKS:
        return None
    return FIELD_CHECKS[rule.name](scope.get(rule.field, rule.key), rule.args)


def _flag_name(number: int, rule: Rule) -> str:
    return f"{rule.level}_{rule.name}_{re.sub(r'\W', '_', rule.field or 'row')}_{number}"


@dataclass(frozen=True)
class CheckedFrame:
    """Data with one boolean per check and two row marks beside it."""

    frame: DataFrame
    data_columns: tuple[str, ...]
    checks: tuple[Check, ...]
    notes: tuple[str, ...] = ()

    @property
    def valid(self) -> DataFrame:
        """Rows without an error; rows with only warnings are among them."""
        return self.frame.where(~F.col(ROW_INVALID)).select(*self._data_cols())

    @property
    def invalid(self) -> DataFrame:
        return self.bad_rows(ERROR).select(*self._data_cols())

    @property
    def warning(self) -> DataFrame:
        """Rows with a warning and no error."""
        return self.bad_rows(WARNING).select(*self._data_cols())

    def bad_rows(self, level: str) -> DataFrame:
        """Rows of one status, flags included.

        The filter is on the rules themselves, not on their flags: a comparison on a plain
        column reaches the scan, which then skips row groups without a bad value.
        """
        rules = [c.broken for c in self.checks if c.rule.level == level]
        broken = reduce(Column.__or__, rules, F.lit(False))
        return self.frame.where(broken if level == ERROR else broken & ~F.col(ROW_INVALID))

    @property
    def flags(self) -> DataFrame:
        marks = [F.col(c.flag) for c in self.checks]
        return self.frame.select(*self._data_cols(), *marks)

    def _data_cols(self) -> list[Column]:
        return [column(n) for n in self.data_columns]


def check(df: DataFrame, rules: Sequence[Rule], millis: Sequence[str] = ()) -> CheckedFrame:
    """Evaluate all checks in one projection, then derive the row marks from them."""
    plan = compile_checks(rules, Scope(df.schema, millis))
    flags = {c.flag: F.coalesce(c.broken, F.lit(False)) for c in plan.checks}
    flagged = df.withColumns(flags) if flags else df
    invalid = _any(c.flag for c in plan.checks if c.is_error)
    warned = _any(c.flag for c in plan.checks if not c.is_error)
    taken = sorted({ROW_INVALID, ROW_WARNING} & {name.lower() for name in df.columns})
    if taken:
        raise ContractError(f"columns bear the names of the row marks: {taken}")
    marked = flagged.withColumns({ROW_INVALID: invalid, ROW_WARNING: warned & ~invalid})
    return CheckedFrame(marked, tuple(df.columns), plan.checks, plan.notes)


def _any(flags) -> Column:
    return reduce(Column.__or__, (F.col(f) for f in flags), F.lit(False))
