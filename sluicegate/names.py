"""Column names as the session compares them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import SparkSession

from sluicegate.errors import ContractError
from sluicegate.partitioning import PartitionSpec


def folding(spark: SparkSession) -> Callable[[str], str]:
    """What two names must have in common to mean one column (``spark.sql.caseSensitive``)."""
    sensitive = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    return (lambda name: name) if sensitive else str.lower


def unused(wanted: str, taken: Iterable[str]) -> str:
    """The name, with as many underscores behind it as make it differ from all others in any case."""
    held = {name.lower() for name in taken}
    while wanted.lower() in held:
        wanted += "_"
    return wanted


def require_distinct(spark: SparkSession, columns: Sequence[str], spec: PartitionSpec) -> None:
    """Refuse names that would overwrite one another, before anything is written.

    Columns and partitions must differ among themselves, and a partition may share a name with a column only
    where that column is its source.
    """
    fold = folding(spark)
    for kind, names in (("columns", columns), ("partitions", [f.name for f in spec.fields])):
        folded = [fold(name) for name in names]
        repeated = sorted({name for name in names if folded.count(fold(name)) > 1})
        if repeated:
            raise ContractError(f"{kind} whose names are the same to this session: {repeated}")
    own = {fold(name) for name in columns}
    taken = [f.name for f in spec.fields if fold(f.name) in own and fold(f.name) != fold(f.source)]
    if taken:
        raise ContractError(f"partitions bear the name of a data column that is not their source: {taken}")
