import pytest

from sluicegate import Contract, LoadContext
from sluicegate.queries.publishing import by_file
from sluicegate.streaming.gate import (
    ACCEPTED,
    QUARANTINED,
    SOURCE_FILE,
    file_stream,
    gate_stream,
    read_batches,
    running_totals,
)

CONTRACT = Contract.from_dicts(
    "s",
    "v1",
    {"fields": [{"name": "k", "type": "int64"}, {"name": "v", "type": "string"}]},
    {
        "fields": {
            "k": {"validate": [{"rule": "required"}, {"rule": "max", "value": 7, "level": "warning"}]},
            "v": {"normalize": [{"op": "upper"}]},
        },
        "partitioning": {"style": "hive", "fields": [{"name": "tc", "source": "tc", "from": "ctx"}]},
    },
)


@pytest.fixture
def drain(spark, tmp_path):
    def run(checkpoint="checkpoint"):
        stream = spark.readStream.schema("k bigint, v string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        ctx = LoadContext.of(CONTRACT, 2024, "ab")
        writer = gate_stream(stream, CONTRACT, ctx, str(tmp_path / "out"), str(tmp_path / checkpoint))
        writer.trigger(availableNow=True).start().awaitTermination()

    return run


def _arrive(spark, tmp_path, rows):
    spark.createDataFrame(rows, "k bigint, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def test_batches_are_gated_and_counted_once(spark, tmp_path, drain):
    _arrive(spark, tmp_path, [(1, "a"), (9, "b")])
    drain()
    _arrive(spark, tmp_path, [(None, "c"), (2, "d")])
    drain()
    _arrive(spark, tmp_path, [(3, "e")])
    drain()
    out = str(tmp_path / "out")
    assert sorted(r.v for r in read_batches(spark, out).collect()) == ["A", "B", "E"]
    assert sorted(r.v for r in read_batches(spark, out, QUARANTINED).collect()) == ["C", "D"]
    assert tuple(running_totals(spark, out).first()) == (5, 4, 1, 1)
    _arrive(spark, tmp_path, [(4, "f")])
    drain()
    assert tuple(running_totals(spark, out).first()) == (6, 5, 1, 1)
    assert len(list((tmp_path / "out" / "totals").glob("*.json"))) == 2


def test_repeated_batches_overwrite_themselves(spark, tmp_path, drain):
    _arrive(spark, tmp_path, [(1, "a"), (9, "b")])
    drain("first")
    drain("second")
    out = str(tmp_path / "out")
    assert tuple(running_totals(spark, out).first()) == (2, 2, 0, 1)
    assert read_batches(spark, out).count() == 2


@pytest.mark.parametrize("files_per_batch", [1, 7, 1000])
def test_what_is_accepted_does_not_depend_on_the_batches(spark, tmp_path, files_per_batch):
    """Three of six files hold an error; the others are accepted, whatever shares their batch."""
    for n in range(6):
        rows = [(10 * n + i, "x") for i in range(3)] + ([(None, "bad")] if n % 2 else [])
        spark.createDataFrame(rows, "k bigint, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    stream = file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, files_per_batch)
    writer = gate_stream(stream, CONTRACT, LoadContext.of(CONTRACT, 2024, "ab"), out, str(tmp_path / "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    accepted, held = read_batches(spark, out), read_batches(spark, out, QUARANTINED)
    assert sorted(r.k for r in accepted.collect()) == [10 * n + i for n in (0, 2, 4) for i in range(3)]
    assert sorted(r.k or -1 for r in held.collect()) == [-1] * 3 + [10 * n + i for n in (1, 3, 5) for i in range(3)]
    assert held.select(SOURCE_FILE).distinct().count() == 3
    assert tuple(running_totals(spark, out).first()) == (21, 18, 3, 15)


@pytest.mark.parametrize("place", [ACCEPTED, QUARANTINED])
def test_the_query_gives_the_same_rows_for_any_batches(spark, place):
    few, many = (by_file(spark, "/root/testdata/sf0.001", place, n) for n in (60, 1000))
    assert few.count() == many.count() > 0 and few.exceptAll(many).count() == 0


def test_a_place_without_rows_reads_as_none(spark, tmp_path, drain):
    _arrive(spark, tmp_path, [(1, "a")])
    drain()
    out = str(tmp_path / "out")
    assert read_batches(spark, out, QUARANTINED).collect() == [] and read_batches(spark, out).count() == 1
    _arrive(spark, tmp_path, [(None, "b")])
    drain()
    assert read_batches(spark, out, QUARANTINED).count() == 1
