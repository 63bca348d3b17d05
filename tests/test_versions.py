"""Publishing by pointers: a reader finds one whole version, wherever the writer stops."""

import pytest

from sluicegate import Contract, LoadContext, run_load
from sluicegate.sinks import files, publish, versions
from sluicegate.sources import slices

PARTITIONS = [
    {"name": "tc", "source": "tc", "from": "ctx"},
    {"name": "ano", "source": "ano", "from": "ctx"},
    {"name": "mes", "source": "mes", "from": "dataframe"},
]


def contract(partitions=PARTITIONS):
    fields = [{"name": "k", "type": "int64"}, {"name": "mes", "type": "string"}]
    rules = {"fields": {"k": {"validate": [{"rule": "required"}]}}, "partitioning": {"style": "hive", "fields": partitions}}
    return Contract.from_dicts("d", "v1", {"fields": fields}, rules)


MONTHS = contract()


@pytest.fixture
def object_store(monkeypatch):
    monkeypatch.setattr(files, "renames_in_place", lambda *a: False)


@pytest.fixture
def load(spark, tmp_path):
    def run(rows, tc="ab", ano=2024, root="store"):
        source = spark.createDataFrame(rows, "k int, mes string")
        return run_load(source, MONTHS, LoadContext.of(MONTHS, ano, tc), str(tmp_path / "out"), str(tmp_path / root))

    return run


@pytest.fixture
def read(spark, tmp_path):
    def rows(ano=None, tc="ab", root="store"):
        where = str(tmp_path / root)
        found = (
            slices.read_all_years(spark, where, MONTHS, tc) if ano is None else slices.read_slice(spark, where, MONTHS, tc=tc, ano=ano)
        )
        assert versions.LOAD not in found.columns
        return sorted((r.k, r.mes, r.tc, r.ano) for r in found.collect())

    return rows


OLD = [(1, "01"), (2, "02"), (3, "007")]
NEW = [(7, "02"), (8, "03")]


def shown(rows, ano=2024, tc="ab"):
    return sorted((k, mes, tc, ano) for k, mes in rows)


def test_the_rows_are_written_once(spark, tmp_path, load, read, object_store, monkeypatch):
    written = []
    original = publish._overwrite
    monkeypatch.setattr(publish, "_overwrite", lambda rows, names, target: (written.append(target), original(rows, names, target)))
    load(OLD)
    result = load(NEW)
    assert len(written) == 2 and written[1] == result.published and "/versions/__load__=" in result.published
    assert read(2024) == shown(NEW) and read() == shown(NEW)
    assert len(list((tmp_path / "store/d/v1/versions").iterdir())) == 1
    assert result.staged is None and not list((tmp_path / "out").rglob("*.parquet"))


@pytest.mark.parametrize("stop", range(8))
def test_interrupted_anywhere_a_reader_sees_one_whole_version(spark, load, read, object_store, monkeypatch, stop):
    load(OLD)
    load(OLD, ano=2023)
    steps = iter(range(100))

    def stopping(original):
        def run(*args, **options):
            if next(steps) == stop:
                raise KeyboardInterrupt
            return original(*args, **options)

        return run

    with monkeypatch.context() as patched:
        for name in ("put_text", "write_text", "remove", "rename"):
            patched.setattr(files, name, stopping(getattr(files, name)))
        patched.setattr(publish, "_overwrite", stopping(publish._overwrite))
        try:
            load(NEW)
        except KeyboardInterrupt:
            pass
    # The put itself, in the steps of a file system without one: written aside, then renamed.
    assert read(2024) == (shown(OLD) if stop <= 2 else shown(NEW))
    assert read(2023) == shown(OLD, 2023) and len(read()) in (5, 6)
    load(NEW)
    assert read(2024) == shown(NEW)


def test_errors_leave_neither_rows_nor_pointers(tmp_path, load, read, object_store):
    load(OLD)
    assert load([(None, "01"), (5, "02")]).published is None
    assert load([]).published is None
    assert read(2024) == shown(OLD)
    assert len(list((tmp_path / "store/d/v1/versions").iterdir())) == 1


def test_scopes_of_several_depths(spark, tmp_path, load, read, object_store):
    """A copy of all years covers the years published before it, and a year published later covers its part of it."""
    for ano in (2022, 2023):
        load(OLD, ano=ano)
    load(OLD, tc="abc")
    rows = slices.read_all_years(spark, str(tmp_path / "store"), MONTHS, "ab")
    root = f"{tmp_path}/copy/d/v1"
    load([(9, "09")], ano=2021, root="copy")
    publish.mirror_scope(rows, root, MONTHS.partitioning, {"tc": "ab"}, "m1", 1)
    both = sorted(shown(OLD, 2022) + shown(OLD, 2023))
    assert read(root="copy") == both and read(2022, root="copy") == shown(OLD, 2022)
    with pytest.raises(FileNotFoundError):
        read(2021, root="copy")
    load(NEW, ano=2023, root="copy")
    load(NEW, ano=2024, root="copy")
    assert read(2023, root="copy") == shown(NEW, 2023)
    assert read(root="copy") == sorted(shown(OLD, 2022) + shown(NEW, 2023) + shown(NEW, 2024))
    publish.mirror_scope(rows, root, MONTHS.partitioning, {"tc": "ab"}, "m2", 1)
    assert read(root="copy") == both and read(tc="abc") == shown(OLD, tc="abc")
    assert [p.name for p in (tmp_path / "copy/d/v1/versions").iterdir()] == ["__load__=m2"]


def test_void_pointers_stay_void_when_nothing_was_cleaned_up(spark, tmp_path, load, read, object_store, monkeypatch):
    monkeypatch.setattr(files, "remove", lambda *a: None)
    load(OLD, ano=2023)
    load(NEW, ano=2023)
    rows = spark.createDataFrame([(5, "05", "ab", 2022)], "k long, mes string, tc string, ano int")
    root = f"{tmp_path}/store/d/v1"
    publish.mirror_scope(rows, root, MONTHS.partitioning, {"tc": "ab"}, "m1", 1)
    assert read() == [(5, "05", "ab", 2022)]
    with pytest.raises(FileNotFoundError):
        read(2023)
    monkeypatch.undo()
    monkeypatch.setattr(files, "renames_in_place", lambda *a: False)
    assert len(versions.remove_unused(spark, root)) == 2
    assert read() == [(5, "05", "ab", 2022)] and versions.remove_unused(spark, root) == []


def test_scopes_published_as_directories_stay_in_force(load, read, monkeypatch):
    load(OLD, ano=2022)
    load(OLD, ano=2023)
    monkeypatch.setattr(files, "renames_in_place", lambda *a: False)
    load(NEW, ano=2023)
    assert read(2022) == shown(OLD, 2022) and read(2023) == shown(NEW, 2023)
    assert read() == sorted(shown(OLD, 2022) + shown(NEW, 2023))
    monkeypatch.undo()
    # A store with pointers keeps to them, also where a rename would do.
    load(OLD, ano=2023)
    assert read() == sorted(shown(OLD, 2022) + shown(OLD, 2023))


def test_a_pointer_is_replaced_in_one_step(spark, tmp_path):
    path = f"{tmp_path}/a/p.json"
    files.put_text(spark, "one", path)
    files.put_text(spark, "two é", path)
    assert files.read_text(spark, path) == "two é" and files.read_text(spark, f"{path}x") is None
    assert [p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith(".")] == ["p.json"]


def test_a_reader_that_is_overtaken_looks_again(spark, load, read, object_store, monkeypatch):
    """A load replaces the scope between a reader's look at the pointer and its list of the files."""
    load(OLD)
    original, overtaken = files.first_data_file, []

    def run(*args):
        if len(overtaken) < 2:
            overtaken.append(args)
            with monkeypatch.context() as patched:
                patched.setattr(files, "first_data_file", original)
                load(NEW if len(overtaken) == 2 else OLD[:1])
        return original(*args)

    monkeypatch.setattr(files, "first_data_file", run)
    assert read(2024) == shown(NEW) and len(overtaken) == 2


def test_a_broken_store_is_told(spark, tmp_path, load, read, object_store):
    load(OLD)
    for path in (tmp_path / "store/d/v1/versions").rglob("*.parquet"):
        path.unlink()
    with pytest.raises(FileNotFoundError):
        read(2024)
