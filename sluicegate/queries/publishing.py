"""Partitioned writes, the gate, and published slices.

Each query writes the whole table to a new scratch directory and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate import partitioning
from sluicegate.contract import Contract
from sluicegate.plans.load import LoadContext, LoadResult, prepare, run_load
from sluicegate.queries.base import dirty_orders, orders_contract, query, table, WITH_DIRTY_ORDERS
from sluicegate.scratch import scratch
from sluicegate.sinks.publish import mirror_scope, read_scope_files, write_scope
from sluicegate.sources import slices
from sluicegate.streaming.gate import ACCEPTED, QUARANTINED, file_stream, gate_stream, read_batches, running_totals

MONTHLY = (("tc", "tc", "ctx"), ("ano", "ano", "ctx"), ("mes", "mes", "dataframe"))
ALL_YEARS = (("tc", "tc", "ctx"), ("ano", "ano", "dataframe"), ("mes", "mes", "dataframe"))
DATED = (("ano", "int32"), ("mes", "int32"))
WARN_ONLY = {"o_orderstatus": {"validate": [{"rule": "in", "values": ["F", "O"], "level": "warning"}]}}
WITH_ERRORS = {"o_totalprice": {"validate": [{"rule": "max", "value": 450000}]}}
YEAR, MONTH = "cast(year(o_orderdate) as integer)", "cast(month(o_orderdate) as integer)"


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in contract order, with the year and month they are partitioned by."""
    orders = table(spark, sf_dir, "orders")
    return orders.withColumns({"ano": F.year("o_orderdate"), "mes": F.month("o_orderdate")})


def _contract(fields=WARN_ONLY, partitions=ALL_YEARS) -> Contract:
    return orders_contract(fields, partitions, DATED)


def _publish(source: DataFrame, contract: Contract, root: str, tc: str, ano: int = 0, **options: bool) -> LoadResult:
    """One scan: the rows are counted as they are written."""
    ctx = LoadContext.of(contract, ano, tc)
    return run_load(source, contract, ctx, f"{root}/out", f"{root}/store", **options)


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select("o_orderkey", "o_totalprice", "tc", "ano", "mes")


@query(f"select distinct 'alpha' as tc, {YEAR} as ano, {MONTH} as mes from orders")
def partition_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _contract().partitioning
    return partitioning.partition_values(_dated_orders(spark, sf_dir), spec, {"tc": "alpha"})


@query(
    WITH_DIRTY_ORDERS
    + """select 'priority' as partition_field,
      count(*) filter (priority_txt is null or trim(priority_txt) = '') as rows_missing from dirty_orders
    union all select 'status', count(*) filter (o_orderstatus is null) from dirty_orders"""
)
def partition_null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    partitions = (("priority", "priority_txt", "dataframe"), ("status", "o_orderstatus", "dataframe"))
    spec = orders_contract(partitions=partitions).partitioning
    return partitioning.partition_null_check(dirty_orders(spark, sf_dir), spec)


@query(f"select o_orderkey, o_totalprice, 'alpha' as tc, {YEAR} as ano, {MONTH} as mes from orders")
def partitioned_write_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, ctx = _contract(), {"tc": "alpha"}
    prepared = prepare(_dated_orders(spark, sf_dir), contract, ctx).frame
    written = write_scope(prepared, contract.partitioning, ctx, scratch(spark))
    return _shown(read_scope_files(spark, written, prepared.schema))


@query(f"select o_orderkey, o_totalprice, 'alpha' as tc, {YEAR} as ano, {MONTH} as mes from orders where {MONTH} = 2")
def publish_replaces_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load has February only; no other month of the first may remain."""
    root, contract, orders = scratch(spark), _contract(), _dated_orders(spark, sf_dir)
    _publish(orders, contract, root, "alpha")
    _publish(orders.where("mes = 2"), contract, root, "alpha")
    return _shown(slices.read_slice(spark, f"{root}/store", contract, tc="alpha"))


@query(
    f"""select o_orderkey, o_totalprice, 'alphab' as tc, {YEAR} as ano, {MONTH} as mes from orders
    union all select o_orderkey, o_totalprice, 'alpha', {YEAR}, {MONTH} from orders where {MONTH} = 2"""
)
def publish_keeps_other_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacing ``alpha`` leaves ``alphab`` alone, although the names start alike."""
    root, contract, orders = scratch(spark), _contract(), _dated_orders(spark, sf_dir)
    _publish(orders, contract, root, "alpha")
    _publish(orders, contract, root, "alphab")
    _publish(orders.where("mes = 2"), contract, root, "alpha")
    both = [_shown(slices.read_slice(spark, f"{root}/store", contract, tc=tc)) for tc in ("alpha", "alphab")]
    return both[0].unionByName(both[1])


@query(
    f"""select o_orderkey, o_totalprice, 'alpha' as tc, {YEAR} as ano, {MONTH} as mes from orders
    where year(o_orderdate) = 1998"""
)
def read_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    _publish(_dated_orders(spark, sf_dir), _contract(), root, "alpha")
    return _shown(slices.read_slice(spark, f"{root}/store", _contract(partitions=MONTHLY), tc="alpha", ano=1998))


@query(f"select o_orderkey, o_totalprice, 'alpha' as tc, {YEAR} as ano, {MONTH} as mes from orders")
def read_all_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    _publish(_dated_orders(spark, sf_dir), _contract(), root, "alpha")
    return _shown(slices.read_all_years(spark, f"{root}/store", _contract(partitions=MONTHLY), "alpha"))


@query(f"select o_orderkey, o_totalprice, 'alpha' as tc, {YEAR} as ano, {MONTH} as mes from orders")
def mirror_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, contract = scratch(spark), _contract()
    _publish(_dated_orders(spark, sf_dir), contract, root, "alpha")
    rows = slices.read_slice(spark, f"{root}/store", contract, tc="alpha")
    mirror_scope(rows, f"{root}/mirror/orders/v1", contract.partitioning, {"tc": "alpha"}, "copy")
    return _shown(slices.read_slice(spark, f"{root}/mirror", contract, tc="alpha"))


@query(
    f"""select o_orderkey, o_totalprice, 'alpha' as tc, {YEAR} as ano, {MONTH} as mes,
      'exported_and_published' as status from orders"""
)
def gate_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings do not block a load."""
    root, contract = scratch(spark), _contract()
    result = _publish(_dated_orders(spark, sf_dir), contract, root, "alpha")
    rows = _shown(slices.read_slice(spark, f"{root}/store", contract, tc="alpha"))
    return rows.withColumn("status", F.lit(result.status))


@query(
    f"""select o_orderkey, o_totalprice, 'alpha' as tc, {YEAR} as ano, {MONTH} as mes,
      'completed_with_invalid_rows_not_published' as status from orders where {MONTH} = 2"""
)
def gate_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load with errors leaves what an earlier load published."""
    root, orders = scratch(spark), _dated_orders(spark, sf_dir)
    _publish(orders.where("mes = 2"), _contract(), root, "alpha")
    # Parquet files give the same rows again, so the checks can come first and nothing is written.
    result = _publish(orders, _contract(WITH_ERRORS), root, "alpha", stable_source=True)
    rows = _shown(slices.read_slice(spark, f"{root}/store", _contract(), tc="alpha"))
    return rows.withColumn("status", F.lit(result.status))


EVENTS = Contract.from_dicts(
    "events",
    "v1",
    {
        "fields": [
            {"name": "event_id", "type": "int64"},
            {"name": "ts", "type": "timestamp[ms]"},
            {"name": "user_id", "type": "int64"},
            {"name": "event_type", "type": "string"},
            {"name": "value", "type": "float64"},
            {"name": "props", "type": "string"},
        ]
    },
    {
        "fields": {
            "event_type": {"normalize": [{"op": "upper"}], "validate": [{"rule": "required"}]},
            "value": {"validate": [{"rule": "max", "value": 250, "level": "warning"}]},
        },
        "partitioning": {"style": "hive", "fields": [{"name": "tc", "source": "tc", "from": "ctx"}]},
    },
)


def _run_stream(spark: SparkSession, sf_dir: str, contract: Contract = EVENTS) -> str:
    """Drain the events table as a stream and return where it went."""
    schema = table(spark, sf_dir, "events").schema
    # A pattern, because a stream takes directories or patterns and the table may be one file.
    return _drain(file_stream(spark, f"{sf_dir}/event[s].parquet", schema), contract)


def _drain(stream: DataFrame, contract: Contract) -> str:
    root = scratch(stream.sparkSession)
    writer = gate_stream(stream, contract, LoadContext.of(contract, 2024, "alpha"), root, f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return root


@query(
    """select count(*) as rows_total, count(*) as rows_valid, 0::bigint as rows_invalid,
      count(*) filter (value > 250) as rows_warning from events"""
)
def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_totals(spark, _run_stream(spark, sf_dir))


@query("select event_id, upper(event_type) as event_type, value from events")
def stream_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_batches(spark, _run_stream(spark, sf_dir)).select("event_id", "event_type", "value")


STRICT_EVENTS = Contract.from_dicts(
    "events",
    "v1",
    EVENTS.schema,
    {
        "fields": {"value": {"validate": [{"rule": "max", "value": 250}]}},
        "partitioning": EVENTS.rules["partitioning"],
    },
)


@query(
    """select event_id, event_type, value from events
    where (select count(*) from events where value > 250) > 0"""
)
def stream_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some events break an error rule, so the file they come in is held back as a whole."""
    root = _run_stream(spark, sf_dir, STRICT_EVENTS)
    return read_batches(spark, root, QUARANTINED).select("event_id", "event_type", "value")


FILES = 256


def by_file(spark: SparkSession, sf_dir: str, place: str, files_per_batch: int) -> DataFrame:
    """The events as many files, gated file by file."""
    events, folder = table(spark, sf_dir, "events"), scratch(spark)
    part = F.col("event_id") % FILES
    events.withColumn("part", part).repartition(FILES, "part").write.partitionBy("part").parquet(folder)
    root = _drain(file_stream(spark, f"{folder}/part=*", events.schema, files_per_batch), STRICT_EVENTS)
    return read_batches(spark, root, place).select("event_id", "event_type", "value")


@query(
    f"""select event_id, event_type, value from events
    where event_id % {FILES} not in (select event_id % {FILES} from events where value > 250)"""
)
def stream_accepted_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without an error are accepted, whichever files share their batch."""
    return by_file(spark, sf_dir, ACCEPTED, 100)


@query(
    f"""select event_id, event_type, value from events
    where event_id % {FILES} in (select event_id % {FILES} from events where value > 250)"""
)
def stream_quarantined_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_file(spark, sf_dir, QUARANTINED, 100)


@query(f"select o_orderkey, o_totalprice, 'alpha' as tc, {MONTH} as mes, {MONTH} as o_month from orders")
def partition_name_differs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partition has a name of its own; its source column stays in the files."""
    contract = orders_contract(WARN_ONLY, (("tc", "tc", "ctx"), ("mes", "o_month", "dataframe")), (("o_month", "int32"),))
    root, orders = scratch(spark), table(spark, sf_dir, "orders").withColumn("o_month", F.month("o_orderdate"))
    _publish(orders, contract, root, "alpha")
    rows = slices.read_slice(spark, f"{root}/store", contract, tc="alpha")
    return rows.select("o_orderkey", "o_totalprice", "tc", "mes", "o_month")


TEXT_PARTITIONS = (("tc", "tc", "ctx"), ("ano", "ano", "dataframe"), ("mm", "mm", "dataframe"), ("carga_id", "carga", "dataframe"))
LOAD_ID = "case when o_orderkey % 2 = 0 then '00000123' else '12345e67' end"


@query(
    f"""select o_orderkey, o_totalprice, 'alpha' as tc, {YEAR} as ano,
      lpad(cast({MONTH} as varchar), 2, '0') as mm, {LOAD_ID} as carga_id from orders"""
)
def mirror_all_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies keep partition values as they stand in the paths, also where no contract column declares them."""
    root = scratch(spark)
    written = orders_contract(WARN_ONLY, TEXT_PARTITIONS, (("ano", "int32"), ("mm", "string"), ("carga", "string")))
    orders = table(spark, sf_dir, "orders").withColumns(
        {"ano": F.year("o_orderdate"), "mm": F.date_format("o_orderdate", "MM"), "carga": F.expr(LOAD_ID)}
    )
    _publish(orders, written, root, "alpha")
    # The copying side knows the partitions, but no contract column behind them.
    bare = orders_contract(WARN_ONLY, TEXT_PARTITIONS)
    rows = slices.read_scope(spark, f"{root}/store", bare, {"tc": "alpha"}, 1, as_text=True)
    mirror_scope(rows, f"{root}/mirror/orders/v1", bare.partitioning, {"tc": "alpha"}, "copy", 1)
    copied = slices.read_all_years(spark, f"{root}/mirror", bare, "alpha")
    return copied.select("o_orderkey", "o_totalprice", "tc", "ano", "mm", "carga_id")
