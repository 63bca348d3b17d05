"""The commands around a load: export a dataset, and bring published slices back."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from sluicegate.contract import Contract, load_contract
from sluicegate.plans.load import LoadContext, LoadResult, run_load
from sluicegate.sinks.publish import mirror_scope
from sluicegate.sources.slices import read_scope
from sluicegate.sources.sql import extract, read_sql_text

# Takes the SQL text and the parameters of a load.
Extractor = Callable[[str, dict[str, Any]], DataFrame]


def export_dataset(
    spark: SparkSession,
    dataset: str,
    version: str,
    ano: int,
    tc: str,
    sql_root: str,
    store_root: str,
    output_root: str,
    extractor: Extractor | None = None,
    publish: bool = True,
    **options: Any,
) -> LoadResult:
    """Run ``<sql_root>/<dataset>/<version>.sql`` under its contract and publish the result.

    ``extractor`` reads from elsewhere than the Spark catalog, for example with
    ``extract_jdbc``.
    """
    contract = load_contract(spark, store_root, dataset, version)
    sql = read_sql_text(spark, f"{sql_root.rstrip('/')}/{contract.dataset}/{contract.version}.sql")
    ctx = LoadContext.of(contract, ano, tc)
    run = extractor or (lambda text, params: extract(spark, text, params))
    # Catalog tables give the same rows again; another source may be a live database.
    options.setdefault("stable_source", extractor is None)
    source = run(sql, {"ano": ctx.ano})
    return run_load(source, contract, ctx, output_root, store_root if publish else None, **options)


# States of a finished copy.
DOWNLOADED = "downloaded"
DOWNLOADED_ALL_YEARS = "downloaded_all_years"


@dataclass(frozen=True)
class CopyResult:
    dataset: str
    version: str
    tc: str
    ano: int | None
    status: str
    copies: tuple[str, ...]  # the replaced scope directory in every target


def download_slice(
    spark: SparkSession, store_root: str, dataset: str, version: str, tc: str, ano: int, *targets: str
) -> CopyResult:
    """Copy one published load to every target root, replacing the same scope there."""
    contract = load_contract(spark, store_root, dataset, version)
    name, year = _name(tc), int(ano)
    copies = _copy(spark, contract, store_root, {"tc": name, "ano": year}, None, targets)
    return CopyResult(contract.dataset, contract.version, name, year, DOWNLOADED, copies)


def download_all_years(
    spark: SparkSession, store_root: str, dataset: str, version: str, tc: str, *targets: str
) -> CopyResult:
    """Copy everything a producer has published."""
    contract = load_contract(spark, store_root, dataset, version)
    name, depth = _name(tc), contract.partitioning.depth_through("tc")
    copies = _copy(spark, contract, store_root, {"tc": name}, depth, targets)
    return CopyResult(contract.dataset, contract.version, name, None, DOWNLOADED_ALL_YEARS, copies)


def _copy(
    spark: SparkSession,
    contract: Contract,
    store_root: str,
    values: dict[str, Any],
    depth: int | None,
    targets: tuple[str, ...],
) -> tuple[str, ...]:
    if not targets:
        raise ValueError("name at least one target to copy to")
    rows = read_scope(spark, store_root, contract, values, depth, as_text=True)
    spec, copy_id = contract.partitioning, uuid.uuid4().hex[:8]
    roots = [f"{t.rstrip('/')}/{contract.dataset}/{contract.version}" for t in targets]
    return tuple(mirror_scope(rows, root, spec, values, copy_id, depth) for root in roots)


def _name(tc: str) -> str:
    name = (tc or "").strip().lower()
    if not name:
        raise ValueError("no producer given")
    return name
