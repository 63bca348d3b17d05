"""One load: prepare, stage, check, gate, publish."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.contract import Contract
from sluicegate.errors import ContractError
from sluicegate.functions.operand import TIMESTAMPS, column
from sluicegate.operators import report
from sluicegate.operators.check import CheckedFrame, check
from sluicegate.operators.cleanup import clean
from sluicegate.operators.schema import Enforced, add_context_columns, enforce_marked, millis_fields, positional_rename
from sluicegate.names import require_distinct
from sluicegate.partitioning import PartitionSpec, ctx_value, missing_value, require_sources
from sluicegate.rules import ERROR, WARNING
from sluicegate.sinks import files
from sluicegate.sinks.publish import publish_scope, read_scope_files, staging_base, write_scope

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadContext:
    dataset: str
    version: str
    ano: int
    tc: str
    carga_id: str = field(default_factory=lambda: uuid.uuid4().hex[:8])

    @classmethod
    def of(cls, contract: Contract, ano: int, tc: str) -> LoadContext:
        return cls(contract.dataset, contract.version, int(ano), tc.strip().lower())


@dataclass(frozen=True)
class LoadResult:
    dataset: str
    version: str
    ano: int
    tc: str
    carga_id: str
    output_dir: str
    status: str
    rows_total: int
    rows_valid: int
    rows_invalid: int
    rows_warning: int
    rule_hits: dict[str, int]
    notes: tuple[str, ...] = ()
    staged: str | None = None
    published: str | None = None
    invalid_samples: str | None = None
    invalid_samples_count: int = 0
    invalid_samples_truncated: bool = False
    warning_samples: str | None = None
    warning_samples_count: int = 0
    warning_samples_truncated: bool = False
    context_mismatches: dict[str, int] = field(default_factory=dict)
    cast_losses: dict[str, int] = field(default_factory=dict)

    def to_dict(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class Prepared:
    frame: DataFrame
    millis: tuple[str, ...]  # millisecond timestamp columns
    notes: tuple[str, ...] = ()
    enforced: Enforced | None = None  # the same rows with marks of the values that the cast lost


def prepare(source: DataFrame, contract: Contract, ctx: LoadContext, carry: Sequence[str] = ()) -> Prepared:
    """Rename, add context, clean and cast: one lazy plan of projections.

    ``carry`` names columns behind those of the contract that come along as they are.
    """
    renamed = positional_rename(source, [*contract.field_names, *carry] if contract.field_names else None)
    cleaned = clean(add_context_columns(renamed, contract.partitioning, ctx), contract.rule_set.cleanups)
    typed = enforce_marked(cleaned.frame, contract.fields, cleaned.millis)
    extras = [n for n in cleaned.millis if n not in contract.field_names]
    return Prepared(typed.frame, (*millis_fields(contract.fields), *extras), cleaned.notes, typed)


def check_prepared(prepared: Prepared, contract: Contract) -> CheckedFrame:
    return check(prepared.frame, contract.rule_set.checks, prepared.millis)


def run_load(
    source: DataFrame,
    contract: Contract,
    ctx: LoadContext,
    output_root: str,
    publish_root: str | None = None,
    max_samples: int = report.DEFAULT_MAX_SAMPLES,
    sample_order: Sequence[str] = (),
    stable_source: bool = False,
    gather: bool = True,
) -> LoadResult:
    """Publish the source if no row has an error; otherwise change nothing published.

    The prepared rows are written once, in their final layout, and counted by the tasks that write them: rows, hits of
    every rule, missing partition values, rows that disagree with the scope, values that a cast lost. So the source
    is read once, and the counts are those of the written files, whatever the source gives on another read. Samples
    come from these files, and lost executors re-read them rather than the source. Without ``publish_root`` the load
    stops after the checks and leaves the files in place.

    ``stable_source`` says that the source gives the same rows on every read, as files do. The checks then run before
    the write as well, over the columns that rules name, and a load with errors writes no data. What is published
    depends on the counts of the write all the same.
    ``gather=False`` skips the shuffle before the write, for a source that already comes in partition order.
    """
    contract.require_sound()
    max_samples = report.max_samples_from(max_samples)
    spark, spec = source.sparkSession, contract.partitioning
    output = f"{output_root.rstrip('/')}/{ctx.dataset}/{ctx.version}/{ctx.carga_id}"
    store = f"{publish_root.rstrip('/')}/{ctx.dataset}/{ctx.version}" if publish_root else None
    base = staging_base(spark, store, ctx.carga_id, f"{output}/data") if store else f"{output}/data"
    # Names that clash and rules that cannot compile fail here, before anything is written.
    require_distinct(spark, contract.field_names, spec)
    prepared = prepare(source, contract, ctx)
    require_distinct(spark, prepared.frame.columns, spec)
    require_sources(prepared.frame, spec)
    checked = check_prepared(prepared, contract)
    notes = (*prepared.notes, *checked.notes)

    staged, counts = None, _count(prepared, contract, ctx) if stable_source else None
    if counts is None or not (counts.rows_invalid or _without_partition(counts, spec)):
        staged, counts = _stage(prepared, contract, ctx, base, gather)
        if counts.rows_invalid or counts.rows_warning:
            snapshot = read_scope_files(spark, staged, prepared.frame.schema)
            checked = check_prepared(Prepared(snapshot, prepared.millis), contract)
    losses = _cast_losses(counts, prepared)
    notes = (*notes, *(f"{rows} values of '{name}' could not be cast and are null" for name, rows in losses.items()))
    for note in notes:
        log.warning(note)

    invalid = _write_samples(checked, ERROR, counts, ctx, output, max_samples, sample_order)
    warning = _Samples()
    published = None
    if counts.rows_invalid > 0:
        files.remove(spark, base)
        staged = None
    else:
        missing = _without_partition(counts, spec)
        if missing:
            files.remove(spark, base)
            raise ContractError(f"rows without a partition value: {missing}")
        warning = _write_samples(checked, WARNING, counts, ctx, output, max_samples, sample_order)
        if store and counts.rows_total > 0:
            published = publish_scope(spark, staged, store, spec, ctx, ctx.carga_id)
        if store and (published is None or base == f"{output}/data"):
            files.remove(spark, base)
        staged = None if store else staged
    return LoadResult(
        **asdict(ctx),
        output_dir=output,
        status=_status(counts, published),
        rows_total=counts.rows_total,
        rows_valid=counts.rows_valid,
        rows_invalid=counts.rows_invalid,
        rows_warning=counts.rows_warning,
        rule_hits=_rule_hits(checked, counts),
        notes=notes,
        staged=staged,
        published=published,
        invalid_samples=invalid.path,
        invalid_samples_count=invalid.count,
        invalid_samples_truncated=invalid.truncated,
        warning_samples=warning.path,
        warning_samples_count=warning.count,
        warning_samples_truncated=warning.truncated,
        context_mismatches=_context_mismatches(counts, contract),
        cast_losses=losses,
    )


def _counts(prepared: Prepared, checked: CheckedFrame, contract: Contract, ctx: LoadContext) -> list[Column]:
    """Everything the gate needs, for one aggregate over the prepared rows with their marks and flags."""
    spec, frame = contract.partitioning, checked.frame
    per_partition_field = [
        F.count_if(missing_value(frame, f.source)).alias(f"missing_{f.name}") for f in spec.data_fields
    ]
    per_ctx_field = [
        F.count_if(~column(f.source).cast("string").eqNullSafe(F.lit(str(ctx_value(ctx, f))))).alias(
            f"mismatch_{f.name}"
        )
        for f in spec.ctx_fields
    ]
    losses = prepared.enforced.losses() if prepared.enforced else []
    return [*report.row_counts(), *report.hit_counts(checked.checks), *per_partition_field, *per_ctx_field, *losses]


def _count(prepared: Prepared, contract: Contract, ctx: LoadContext) -> Row:
    """The counts of the source itself, from a scan of the columns they need."""
    checked = check(prepared.enforced.marked, contract.rule_set.checks, prepared.millis)
    return checked.frame.agg(*_counts(prepared, checked, contract, ctx)).first()


def _stage(prepared: Prepared, contract: Contract, ctx: LoadContext, base: str, gather: bool) -> tuple[str, Row]:
    """Write the rows and count them on their way into the files.

    They are counted behind the shuffle, by the tasks that write: Spark takes the counts of such a task once, also
    when it runs again, while those of tasks before a shuffle are added again where lost executors make it repeat them.
    """
    seen = Observation()

    def watch(rows: DataFrame) -> DataFrame:
        checked = check(rows, contract.rule_set.checks, prepared.millis)
        observed = checked.frame.observe(seen, *_counts(prepared, checked, contract, ctx))
        return observed.select(*[column(n) for n in rows.columns if n not in prepared.enforced.marks])

    staged = write_scope(prepared.enforced.marked, contract.partitioning, ctx, base, gather=gather, watch=watch)
    return staged, Row(**seen.get)


def _without_partition(counts: Row, spec: PartitionSpec) -> dict[str, int]:
    missing = {f.name: counts[f"missing_{f.name}"] for f in spec.data_fields}
    return {name: rows for name, rows in missing.items() if rows}


def _cast_losses(counts: Row, prepared: Prepared) -> dict[str, int]:
    lost = {name: counts[f"lost_{n}"] for n, name in enumerate(prepared.enforced.lossy)}
    return {name: rows for name, rows in lost.items() if rows}


def _context_mismatches(counts: Row, contract: Contract) -> dict[str, int]:
    """Rows whose own value differs from the scope they are published under."""
    found = {f.name: counts[f"mismatch_{f.name}"] for f in contract.partitioning.ctx_fields}
    found = {name: rows for name, rows in found.items() if rows}
    if found:
        log.warning("rows disagree with the scope of the load: %s", found)
    return found


def _rule_hits(checked: CheckedFrame, counts: Row) -> dict[str, int]:
    hits: dict[str, int] = {}
    for c in checked.checks:
        hits[c.rule.key] = hits.get(c.rule.key, 0) + counts[c.flag]
    return dict(sorted(((k, n) for k, n in hits.items() if n), key=lambda item: -item[1]))


def _status(counts: Row, published: str | None) -> str:
    if counts.rows_total == 0:
        return report.NO_ROWS
    if counts.rows_invalid > 0:
        return report.INVALID_NOT_PUBLISHED
    return report.PUBLISHED if published else report.VALIDATED_NOT_PUBLISHED


@dataclass(frozen=True)
class _Samples:
    path: str | None = None
    count: int = 0
    truncated: bool = False


def _write_samples(
    checked: CheckedFrame,
    level: str,
    counts: Row,
    ctx: LoadContext,
    output: str,
    max_samples: int,
    order: Sequence[str],
) -> _Samples:
    """Write one JSON document: what the samples belong to, and the rows with their reasons.

    At most ``max_samples`` rows come to the driver. Without an order, Spark stops scanning
    as soon as it has that many.
    """
    matched = counts.rows_invalid if level == ERROR else counts.rows_warning
    count = min(matched, max(0, max_samples))
    if count == 0:
        return _Samples()
    kind = "invalid" if level == ERROR else "warning"
    path, truncated = f"{output}/errors/{kind}_samples.json", matched >= max_samples
    hits = _rule_hits(checked, counts).items()
    report_document = {
        **asdict(ctx),
        "kind": kind,
        "generated_at": datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "rows_total_processed": counts.rows_total,
        "rows_matched_processed": matched,
        "samples_count": count,
        "max_samples": max_samples,
        "truncated": truncated,
        "rules_summary": [{"key": k, "count": n} for k, n in hits if k.startswith(f"{level}:")],
        "samples": _sample_documents(report.choose_samples(checked, level, max_samples, order), max_samples),
    }
    files.write_text(checked.frame.sparkSession, json.dumps(report_document, ensure_ascii=False, indent=2), path)
    return _Samples(path, count, truncated)


def _sample_documents(rows: DataFrame, limit: int) -> list[dict]:
    exact_as_text = {
        f.name: column(f.name).cast("string")
        for f in rows.schema.fields
        if isinstance(f.dataType, (T.DecimalType, *TIMESTAMPS))
    }
    shown = rows.withColumns(exact_as_text) if exact_as_text else rows
    whole = F.struct(*[column(n) for n in shown.columns])
    texts = shown.select(F.to_json(whole, {"ignoreNullFields": "false"})).take(limit)
    return [{**json.loads(text), "__sample_seq__": n} for n, (text,) in enumerate(texts, start=1)]
