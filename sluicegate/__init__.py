"""Contract-driven checks and publishing for Spark tables."""

from sluicegate.contract import Contract, ContractError, Issue, load_contract
from sluicegate.partitioning import PartitionField, PartitionSpec
from sluicegate.plans.load import LoadContext, LoadResult, run_load

__all__ = [
    "Contract",
    "ContractError",
    "Issue",
    "LoadContext",
    "LoadResult",
    "PartitionField",
    "PartitionSpec",
    "load_contract",
    "run_load",
]
