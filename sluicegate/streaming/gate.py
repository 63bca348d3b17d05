"""Gate the files, or else the micro-batches, of a stream, and keep running totals."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sluicegate.contract import Contract
from sluicegate.functions.operand import column
from sluicegate.operators import report
from sluicegate.operators.check import ROW_INVALID, CheckedFrame
from sluicegate.plans.load import LoadContext, check_prepared, prepare
from sluicegate.rules import ERROR
from sluicegate.sinks import files
from sluicegate.sinks.publish import COMPRESSION

ACCEPTED, QUARANTINED = "accepted", "quarantined"
TOTALS = ("rows_total", "rows_valid", "rows_invalid", "rows_warning")
DEFAULT_FILES_PER_BATCH = 1000
# The column that tells the file of a row, and the place of its file.
SOURCE_FILE, PLACE = "__source_file__", "__place__"


def file_stream(
    spark: SparkSession, pattern: str, schema: T.StructType, files_per_batch: int = DEFAULT_FILES_PER_BATCH
) -> DataFrame:
    """Parquet files as a stream, with the file of each row behind its columns.

    Every file is accepted or quarantined as a whole, so the number of files in a batch is only a matter of speed.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(pattern)
    return rows.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def gate_stream(
    stream: DataFrame, contract: Contract, ctx: LoadContext, root: str, checkpoint: str
) -> DataStreamWriter:
    """A writer that sends rows to ``accepted`` or ``quarantined``.

    Where the stream tells the file of each row (``file_stream``), a file with any error is held back as a whole,
    and the others of its batch are accepted. Other streams have no such units: a batch is accepted or held back.
    Each batch has its own directories, which a repeated batch overwrites: after a failure nothing is counted or kept
    twice. Choose a trigger and start it.
    """

    def gate(batch: DataFrame, batch_id: int) -> None:
        by_file = SOURCE_FILE in batch.columns
        prepared = prepare(batch, contract, ctx, carry=(SOURCE_FILE,) if by_file else ())
        checked = check_prepared(prepared, contract)
        place = _place_by_file(checked) if by_file else F.lit(ACCEPTED)
        staged = f"{root}/_staging/batch_id={batch_id}"
        counts = _stage(checked, place, staged)
        if counts["wrong"] and by_file:
            raise RuntimeError(f"{counts['wrong']} rows with errors came from files that had none: the files changed")
        spark = batch.sparkSession
        held = {to: f"{staged}/{PLACE}={to}" for to in (ACCEPTED, QUARANTINED)}
        if counts["wrong"]:
            held = {ACCEPTED: None, QUARANTINED: held[ACCEPTED]}
        for to, rows in held.items():
            _move(spark, rows, f"{root}/{to}/batch_id={batch_id}")
        files.remove(spark, staged)
        _add_totals(spark, root, batch_id, {name: counts[name] for name in TOTALS})

    return stream.writeStream.foreachBatch(gate).option("checkpointLocation", checkpoint)


def _place_by_file(checked: CheckedFrame) -> Column:
    """The place of a row's file, from a scan of the columns that rules name.

    The names of files with errors come to the driver, which has the names of all files of the batch already.
    """
    bad = [row[0] for row in checked.bad_rows(ERROR).select(SOURCE_FILE).distinct().collect()]
    return F.when(F.col(SOURCE_FILE).isin(bad), QUARANTINED).otherwise(ACCEPTED) if bad else F.lit(ACCEPTED)


def _stage(checked: CheckedFrame, place: Column, staged: str) -> dict[str, int]:
    """Write the rows once, by place, and count them on their way; ``wrong`` are rows with errors among the accepted."""
    seen = Observation()
    wrong = F.count_if(F.col(ROW_INVALID) & (F.col(PLACE) == ACCEPTED)).alias("wrong")
    rows = checked.frame.withColumn(PLACE, place).observe(seen, *report.row_counts(), wrong)
    written = rows.select(*[column(n) for n in checked.data_columns], PLACE).write.mode("overwrite")
    written.option("partitionOverwriteMode", "static").option("compression", COMPRESSION).partitionBy(PLACE).parquet(staged)
    return seen.get


def read_batches(spark: SparkSession, root: str, place: str = ACCEPTED) -> DataFrame:
    """The rows of one place over all batches; none, with the columns of the other place, where it got none so far."""
    if files.has_data(spark, f"{root}/{place}"):
        return spark.read.option("basePath", f"{root}/{place}").parquet(f"{root}/{place}")
    other = QUARANTINED if place == ACCEPTED else ACCEPTED
    return spark.read.option("basePath", f"{root}/{other}").parquet(f"{root}/{other}").where(F.lit(False))


def running_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals over all batches so far, in one row; all 0 before the first batch."""
    kept = _kept_totals(spark, root)
    if not kept:
        return spark.range(1).select(*[F.lit(0).cast("long").alias(n) for n in TOTALS])
    return spark.read.schema(TOTALS_SCHEMA).json(f"{root}/totals/{max(kept)}.json")


TOTALS_SCHEMA = ", ".join(f"{name} long" for name in TOTALS)


def _kept_totals(spark: SparkSession, root: str) -> list[int]:
    names = files.names(spark, f"{root}/totals")
    return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())


def _add_totals(spark: SparkSession, root: str, batch_id: int, counts: dict[str, int]) -> None:
    """Write the totals up to this batch. A repeated batch starts from the same earlier totals; the two latest
    files stay, so their number does not grow with the stream."""
    earlier = [number for number in _kept_totals(spark, root) if number < batch_id]
    if earlier:
        before = spark.read.schema(TOTALS_SCHEMA).json(f"{root}/totals/{earlier[-1]}.json").first()
        counts = {name: counts[name] + before[name] for name in TOTALS}
    files.write_text(spark, json.dumps(counts), f"{root}/totals/{batch_id}.json")
    for number in earlier[:-1]:
        files.remove(spark, f"{root}/totals/{number}.json")


def _move(spark: SparkSession, staged: str | None, target: str) -> None:
    """Put what was staged, perhaps nothing, in the place of an earlier run's rows."""
    if staged is None or not files.exists(spark, staged):
        files.remove(spark, target)
    elif files.renames_in_place(spark, staged, target):
        files.remove(spark, target)
        files.rename(spark, staged, target)
    else:
        rows = spark.read.parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "static")
        rows.option("compression", COMPRESSION).parquet(target)
        files.remove(spark, staged)
