"""Read published slices back, with the types the contract gives their partition columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluicegate.contract import Contract
from sluicegate.functions.casts import parse_token
from sluicegate.sinks import files, versions


# How often a slice is looked up again that is replaced meanwhile.
ATTEMPTS = 5

# Fixed value: the scope field that is a number.
YEAR = "ano"


def read_scope(
    spark: SparkSession,
    root: str,
    contract: Contract,
    values: Mapping[str, Any],
    depth: int | None = None,
    as_text: bool = False,
) -> DataFrame:
    """Read the directory of the first ``depth`` partition values, and nothing beside it.

    Only that directory is listed, once, so the cost does not grow with the other slices, and
    a producer ``ab`` never picks up ``abc``. Where scopes are published by pointers these are
    followed. ``as_text`` keeps partition values as they stand in the paths, for copies.
    """
    root = f"{root.rstrip('/')}/{contract.dataset}/{contract.version}"
    scope = contract.partitioning.scope_path(values, depth)
    frames: list[DataFrame] = []
    for _ in range(ATTEMPTS):
        found = versions.sources(spark, root, scope)
        frames = _frames(spark, found, contract, as_text)
        # Where pointers moved on while files were listed, the list may be of files that are gone.
        if found == versions.sources(spark, root, scope):
            break
    if not frames:
        raise FileNotFoundError(f"nothing is published for {scope} in {root}")
    return reduce(DataFrame.unionByName, frames)


def _frames(spark: SparkSession, found: list[versions.Source], contract: Contract, as_text: bool) -> list[DataFrame]:
    try:
        read = [_read(spark, source, contract, as_text) for source in found]
    except (AnalysisException, Py4JJavaError):
        if not any(source.base.endswith("/versions") for source in found):
            raise
        return []
    return [frame for frame in read if frame is not None]


def _read(spark: SparkSession, source: versions.Source, contract: Contract, as_text: bool) -> DataFrame | None:
    """The rows of some directories; none where there are no files. The columns are those of one file."""
    first = [files.first_data_file(spark, path) for path in source.paths]
    held = [path for path, file in zip(source.paths, first) if file]
    if not held:
        return None
    own = spark.read.parquet(next(filter(None, first))).schema
    reader = spark.read.option("basePath", source.base).schema(_typed(own, contract, as_text))
    return reader.parquet(*held).drop(versions.LOAD)


def read_slice(spark: SparkSession, root: str, contract: Contract, **values: Any) -> DataFrame:
    """One published load: a value for every scope field, such as ``tc`` and ``ano``."""
    return read_scope(spark, root, contract, values)


def read_all_years(spark: SparkSession, root: str, contract: Contract, tc: str) -> DataFrame:
    """Everything a producer has published: partition levels below ``tc`` are all read."""
    return read_scope(spark, root, contract, {"tc": tc}, contract.partitioning.depth_through("tc"))


def _typed(found: T.StructType, contract: Contract, as_text: bool) -> T.StructType:
    """The columns of a file, then the partitions; these get contract types, or text, but for the year.

    Spark alone would turn ``007`` into 7, and ``12345e67`` into a floating number.
    """
    declared = {str(f["name"]).strip(): parse_token(f.get("type")).dtype for f in contract.fields}
    kinds: dict[str, T.DataType] = {}
    for f in contract.partitioning.fields:
        undeclared = T.IntegerType() if f.source == YEAR else T.StringType()
        kinds[f.name] = T.StringType() if as_text else declared.get(f.source, undeclared)
    own = [f for f in found.fields if f.name not in kinds]
    return T.StructType([*own, *(T.StructField(name, kind) for name, kind in kinds.items())])
