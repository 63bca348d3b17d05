"""Counts, summaries and samples of checked data."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicegate.functions.checks import DOCUMENT_CHECK
from sluicegate.functions.operand import column
from sluicegate.operators.check import ROW_INVALID, ROW_WARNING, Check, CheckedFrame
from sluicegate.rules import ERROR, WARNING, Rule

DEFAULT_MAX_SAMPLES = 100
MERGE_GROUPS = 1024
# Up to so many rows Spark ranks within tasks before it shuffles.
RANKED_ROWS = "spark.sql.optimizer.windowGroupLimitThreshold"

# States of a load.
NO_ROWS = "completed_with_no_rows"
INVALID_NOT_PUBLISHED = "completed_with_invalid_rows_not_published"
VALIDATED_NOT_PUBLISHED = "validated_not_published"
PUBLISHED = "exported_and_published"

# Message per rule; {} takes the argument named beside it.
MESSAGES: dict[str, tuple[str, str | None]] = {
    "required": ("Campo obrigatório ausente ou vazio", None),
    "notnull": ("Campo obrigatório ausente ou vazio", None),
    "min": ("Valor abaixo do mínimo permitido ({})", "value"),
    "max": ("Valor acima do máximo permitido ({})", "value"),
    "gt": ("Valor deve ser maior que ({})", "value"),
    "ge": ("Valor deve ser maior ou igual a ({})", "value"),
    "max_length": ("Tamanho acima do máximo permitido ({})", "value"),
    "regex": ("Valor fora do formato esperado", None),
    "in": ("Valor fora do conjunto permitido", None),
    "date_gte": ("Data anterior ao mínimo permitido ({})", "value"),
    "date_lte": ("Data posterior ao máximo permitido ({})", "value"),
    "date_format": ("Data fora do formato esperado ({})", "format"),
    "decimal_scale": ("Quantidade de casas decimais acima do permitido ({})", "scale"),
    DOCUMENT_CHECK: ("CPF/CNPJ incompatível com o tipo de credor", None),
}


def message(rule: Rule) -> str:
    text, argument = MESSAGES.get(rule.name, (f"Regra violada: {rule.name}", None))
    return text if argument is None else text.format(rule.args.get(argument))


def max_samples_from(raw: object) -> int:
    """Sample limit of a load: 100 when missing or unreadable, none at or below zero."""
    try:
        return max(0, int(raw))  # type: ignore[call-overload]
    except (TypeError, ValueError):
        return DEFAULT_MAX_SAMPLES


def row_counts() -> list[Column]:
    """The four row counts, for use in one ``agg`` over a checked frame."""
    return [
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(~F.col(ROW_INVALID)).alias("rows_valid"),
        F.count_if(F.col(ROW_INVALID)).alias("rows_invalid"),
        F.count_if(F.col(ROW_WARNING)).alias("rows_warning"),
    ]


def hit_counts(checks: Sequence[Check]) -> list[Column]:
    return [F.count_if(F.col(c.flag)).alias(c.flag) for c in checks]


def load_summary(checked: CheckedFrame) -> DataFrame:
    return checked.frame.agg(*row_counts())


def hits_per_key(checks: Sequence[Check]) -> list[tuple[Rule, Column]]:
    """Hits of each rule key over the counted flags; rules that share a key add up."""
    sums: dict[str, tuple[Rule, Column]] = {}
    for c in checks:
        rule, total = sums.get(c.rule.key, (c.rule, F.lit(0).cast("bigint")))
        sums[c.rule.key] = (rule, total + F.col(c.flag))
    return list(sums.values())


def rule_counts(checked: CheckedFrame) -> DataFrame:
    """Hits per rule key, zeros included: one aggregate, then one row per key."""
    return _key_rows(checked, hits_per_key(checked.checks))


def alias_counts(checked: CheckedFrame) -> DataFrame:
    """Hits per declared rule, so that rules sharing a key stay apart."""
    return _key_rows(checked, [(c.rule, F.col(c.flag)) for c in checked.checks], flags=True)


def _key_rows(checked: CheckedFrame, hits: list[tuple[Rule, Column]], flags: bool = False) -> DataFrame:
    spark = checked.frame.sparkSession
    if not hits:
        schema = "key string, level string, rule string, field string, hits bigint"
        return spark.createDataFrame([], schema + (", flag string" if flags else ""))
    names = [c.flag for c in checked.checks] if flags else [None] * len(hits)
    counted = checked.frame.agg(*hit_counts(checked.checks))
    rows = [
        F.struct(
            F.lit(rule.key).alias("key"),
            F.lit(rule.level).alias("level"),
            F.lit(rule.name).alias("rule"),
            F.lit(rule.field).cast("string").alias("field"),
            total.alias("hits"),
            *([F.lit(name).alias("flag")] if flags else []),
        )
        for (rule, total), name in zip(hits, names)
    ]
    return counted.select(F.inline(F.array(*rows)))


def rules_summary(checked: CheckedFrame, level: str | None = None) -> DataFrame:
    """Keys that were hit, most hits first."""
    counts = rule_counts(checked).where("hits > 0")
    if level is not None:
        counts = counts.where(F.col("level") == level)
    return counts.select("key", "hits").orderBy(F.desc("hits"), "key")


def issues(checks: Sequence[Check], level: str) -> Column:
    """The broken rules of one level on a row, with a message each."""
    found = [
        F.when(
            F.col(c.flag),
            F.struct(
                F.lit(c.rule.level).alias("level"),
                F.lit(c.rule.name).alias("rule"),
                F.lit(c.rule.field).cast("string").alias("field"),
                F.lit(c.rule.key).alias("key"),
                F.lit(message(c.rule)).alias("message"),
            ),
        )
        for c in checks
        if c.rule.level == level
    ]
    if not found:
        kind = "array<struct<level:string,rule:string,field:string,key:string,message:string>>"
        return F.array().cast(kind)
    return F.array_compact(F.array(*found))


def samples(
    checked: CheckedFrame,
    level: str,
    max_samples: int = DEFAULT_MAX_SAMPLES,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Up to ``max_samples`` bad rows with their reasons, numbered from one.

    ``order_by`` makes the choice repeatable. Without it any rows are taken. For an ordered
    choice of over 1000 rows run the plan within ``ranked_in_tasks``, or all bad rows are shuffled.
    """
    chosen = choose_samples(checked, level, max_samples, order_by)
    # The limit leaves at most max_samples rows for this window.
    numbered = Window.orderBy(*([column(n) for n in order_by] or [F.lit(1)]))
    return chosen.withColumn("__sample_seq__", F.row_number().over(numbered))


def choose_samples(
    checked: CheckedFrame, level: str, max_samples: int, order_by: Sequence[str] = ()
) -> DataFrame:
    bad = checked.bad_rows(level).select(
        *[column(n) for n in checked.data_columns], issues(checked.checks, level).alias("__issues__")
    )
    if max_samples <= 0 or not order_by:
        return bad.limit(max(0, max_samples))
    return _first(bad, [column(n) for n in order_by], max_samples)


@contextmanager
def ranked_in_tasks(spark: SparkSession, count: int) -> Iterator[None]:
    """Plan ordered samples so that tasks keep only their first ``count`` rows, also beyond Spark's own limit."""
    held = spark.conf.get(RANKED_ROWS)
    spark.conf.set(RANKED_ROWS, str(max(int(held), count)))
    try:
        yield
    finally:
        spark.conf.set(RANKED_ROWS, held)


def _first(df: DataFrame, keys: Sequence[Column], count: int) -> DataFrame:
    """The first rows in order, merged in two levels.

    Each task keeps its own first rows. Sent to one task directly, those of a million
    tasks would be far more than the result; groups of tasks merge theirs first. More rows than Spark ranks
    within tasks are sorted there, and cut by their place.
    """
    group, rank = "__merge_group__", "__rank__"
    if count > int(df.sparkSession.conf.get(RANKED_ROWS)):
        own = _first_of_task(df.withColumn(group, F.spark_partition_id() % MERGE_GROUPS), keys, count)
        return _first_of_task(own.repartition(group).drop(group), keys, count).orderBy(*keys).limit(count)
    in_group = Window.partitionBy(group).orderBy(*keys)
    merged = (
        df.withColumn(group, F.spark_partition_id() % MERGE_GROUPS)
        .withColumn(rank, F.row_number().over(in_group))
        .where(F.col(rank) <= count)
        .drop(group, rank)
    )
    return merged.orderBy(*keys).limit(count)


def _first_of_task(df: DataFrame, keys: Sequence[Column], count: int) -> DataFrame:
    """The first rows of each task. The numbers that Spark gives to rows count up within a task from its lowest bits."""
    place = "__place__"
    numbered = df.sortWithinPartitions(*keys).withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    return numbered.where(F.col(place) < count).drop(place)


def invalid_samples(
    checked: CheckedFrame, max_samples: int = DEFAULT_MAX_SAMPLES, order_by: Sequence[str] = ()
) -> DataFrame:
    return samples(checked, ERROR, max_samples, order_by)


def warning_samples(
    checked: CheckedFrame, max_samples: int = DEFAULT_MAX_SAMPLES, order_by: Sequence[str] = ()
) -> DataFrame:
    return samples(checked, WARNING, max_samples, order_by)


def status_column(publish: bool) -> Column:
    """State of a load from its row counts."""
    return (
        F.when(F.col("rows_total") == 0, NO_ROWS)
        .when(F.col("rows_invalid") > 0, INVALID_NOT_PUBLISHED)
        .otherwise(PUBLISHED if publish else VALIDATED_NOT_PUBLISHED)
    )


def load_status(checked: CheckedFrame, publish: bool = True, max_samples: int = DEFAULT_MAX_SAMPLES) -> DataFrame:
    """Counts, state and whether the samples could not hold every bad row's like."""

    def full(rows: str) -> Column:
        return (F.col(rows) >= max_samples) & F.lit(max_samples > 0)

    return load_summary(checked).select(
        "*",
        status_column(publish).alias("status"),
        full("rows_invalid").alias("invalid_samples_truncated"),
        full("rows_warning").alias("warning_samples_truncated"),
    )
