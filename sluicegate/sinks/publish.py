"""Write partitioned Parquet, and replace one published scope with it."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.operand import column
from sluicegate.names import require_distinct
from sluicegate.partitioning import PartitionSpec
from sluicegate.sinks import files, versions

COMPRESSION = "zstd"


def write_scope(
    df: DataFrame,
    spec: PartitionSpec,
    ctx: Any,
    base: str,
    depth: int | None = None,
    gather: bool = True,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Write one scope below ``base`` as ``name=value`` directories; returns its directory.

    ``gather`` brings rows of a partition together before the write, so that a partition
    does not get one file from every task. It is a rebalance, not a plain repartition: a
    partition that holds a third of the rows is split over many tasks.

    ``watch`` sees the rows behind that shuffle, in the tasks that write them, and returns what is written of them.
    It must keep the partition columns.
    """
    inner = spec.fields[len(spec.ctx_values(ctx, depth)) :]
    copies = {f.name: column(f.source) for f in inner if f.name != f.source}
    out = df.withColumns(copies) if copies else df
    names = [f.name for f in inner]
    require_distinct(df.sparkSession, df.columns, spec)
    if names and gather and _adaptive(df.sparkSession):
        out = out.hint("rebalance", *[column(n) for n in names])
    elif names and gather:
        out = _dealt(out, names)
    target = f"{base.rstrip('/')}/{spec.scope_path(ctx, depth)}"
    _overwrite(watch(out) if watch else out, names, target)
    return target


def _dealt(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of a partition in as many tasks as its share of all rows asks for.

    Without adaptive execution nothing splits a large partition behind the shuffle. So the rows per partition are
    counted before, in a scan of the partition columns, and each partition gets tasks of its own, none with more
    rows than an even dealing of all rows would give; small partitions share tasks. The counts, one per directory
    that the load writes, pass through the driver.
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"__key_{n}__" for n in range(len(names))]
    counts = rows.groupBy(*[column(n).alias(k) for n, k in zip(names, keys)]).count().collect()
    even = max(1, math.ceil(sum(c["count"] for c in counts) / tasks))
    dealt, first = [], 0
    for c in sorted(counts, key=lambda c: -c["count"]):
        shares = math.ceil(c["count"] / even)
        dealt.append((*(c[k] for k in keys), first, shares))
        first += shares
    kinds = [T.StructField(k, rows.schema[n].dataType) for n, k in zip(names, keys)]
    held = [T.StructField(name, T.IntegerType()) for name in ("__first__", "__shares__")]
    plan = spark.createDataFrame(dealt, T.StructType([*kinds, *held]))
    same = reduce(Column.__and__, (column(n).eqNullSafe(F.col(k)) for n, k in zip(names, keys)))
    # The same rows go the same way when a task runs again; equal rows spread over the tasks they come from.
    plain = [column(f.name) for f in rows.schema.fields if not {"map", "variant"} & set(re.findall(r"\w+", f.dataType.simpleString()))]
    turn = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.col("__shares__"))
    placed = rows.join(plan, same, "left")
    # Rows of a partition that a changing source has only now go to any task.
    task = F.coalesce(F.pmod(F.col("__first__") + turn, F.lit(tasks)), F.lit(0)).cast("int")
    return placed.repartitionById(tasks, task).drop(*keys, "__first__", "__shares__")


def _overwrite(rows: DataFrame, names: Sequence[str], target: str) -> None:
    """Replace all of the target, whatever the session says about partitions that get no rows."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.option("compression", COMPRESSION).partitionBy(*names).parquet(target)


def read_scope_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a scope directory that was just written, with the types it was written with."""
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    return spark.read.schema(nullable).parquet(path).select(*[column(f.name) for f in schema.fields])


def staging_base(spark: SparkSession, root: str, load_id: str, elsewhere: str) -> str:
    """Where a load should write what it will publish below ``root``, so that publishing moves no row.

    Where a rename is cheap that is ``elsewhere``, from where the directory changes places. Elsewhere it is the
    load's own directory in the store, to which a pointer is set.
    """
    return versions.version_dir(root, load_id) if points(spark, elsewhere, root) else elsewhere


def points(spark: SparkSession, staged: str, root: str) -> bool:
    """Whether scopes below ``root`` are published by pointers: where some are already, and where a rename copies."""
    return not files.renames_in_place(spark, staged, root) or versions.in_use(spark, root)


def publish_scope(
    spark: SparkSession,
    staged: str,
    root: str,
    spec: PartitionSpec,
    ctx: Any,
    load_id: str,
    depth: int | None = None,
) -> str:
    """Make a staged scope the published one; returns its directory. Other scopes are not touched.

    ``staged`` is the directory ``write_scope`` returned. Where a rename is cheap the directories change places. On
    object stores a pointer is set to the staged rows in one put (see ``versions``), so that a reader finds the whole
    old scope or the whole new one, wherever the writer stops. Rows staged elsewhere than in ``staging_base`` are copied
    there by tasks before.
    """
    if not files.has_data(spark, staged):
        raise FileNotFoundError(f"nothing to publish in {staged}")
    scope = spec.scope_path(ctx, depth)
    target = f"{root.rstrip('/')}/data/{scope}"
    if not points(spark, staged, root.rstrip("/")):
        retired = f"{root.rstrip('/')}/_retired/{load_id}"
        files.replace_directory(spark, staged, target, f"{retired}/{scope}")
        files.remove(spark, retired)
        return target
    own = f"{versions.version_dir(root.rstrip('/'), load_id)}/{scope}"
    if staged != own:
        inner = [f.name for f in spec.fields[len(spec.ctx_values(ctx, depth)) :]]
        rows = spark.read.schema(_with_text(spark.read.parquet(staged).schema, inner)).parquet(staged)
        _overwrite(rows, inner, own)
        files.remove(spark, staged)
    return versions.publish(spark, root.rstrip("/"), scope, load_id)


def mirror_scope(
    df: DataFrame,
    root: str,
    spec: PartitionSpec,
    values: Mapping[str, Any],
    load_id: str,
    depth: int | None = None,
) -> str:
    """Replace the same scope in another store with rows read from the first.

    The rows come in partition order already, so they are written without a shuffle.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    # The rows bring their partition columns under the partitions' own names.
    spec = PartitionSpec(tuple(replace(f, source=f.name) for f in spec.fields))
    staging = f"{root}/_staging/{load_id}"
    staged = write_scope(df, spec, values, staging_base(spark, root, load_id, staging), depth, gather=False)
    target = publish_scope(spark, staged, root, spec, values, load_id, depth)
    files.remove(spark, staging)
    return target


def _with_text(schema: T.StructType, names: list[str]) -> T.StructType:
    """Partition values as the text they have in paths, so that ``007`` stays ``007``."""
    return T.StructType([T.StructField(f.name, T.StringType() if f.name in names else f.dataType) for f in schema.fields])


def _adaptive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.adaptive.enabled", "true") == "true"
