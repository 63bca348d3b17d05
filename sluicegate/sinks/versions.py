"""Published scopes where a directory cannot be renamed: one directory per load, and a pointer to the current one.

Below the root of a dataset's version lie

- ``versions/__load__=<load id>/<scope>/...``: the rows of one load, written once and never changed,
- ``pointers/<scope>/current.json``: which load a scope's rows are from; replaced in one put,
- ``data/<scope>/...``: scopes that were published without pointers, in force where no pointer covers them.

A reader follows pointers, so before the put it finds the whole old scope and after it the whole new one, wherever the
writer stops. A pointer covers all scopes below its own, except those with a pointer that was put later: a pointer
names the loads of the pointers it found below itself (``replaces``), and these are void from then on.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from sluicegate.sinks import files

LOAD = "__load__"
POINTER = "current.json"


@dataclass(frozen=True)
class Pointer:
    scope: str
    load: str
    replaces: tuple[str, ...] = ()

    def covers(self, scope: str) -> bool:
        """Whether a scope lies below this one."""
        return scope.startswith(f"{self.scope}/")


@dataclass(frozen=True)
class Source:
    """Directories with rows of one scope, below a common base from which partition values are read."""

    base: str
    paths: tuple[str, ...]


def version_dir(root: str, load_id: str) -> str:
    return f"{root}/versions/{LOAD}={load_id}"


def _pointer_file(root: str, scope: str) -> str:
    return f"{root}/pointers/{scope}/{POINTER}"


def in_use(spark: SparkSession, root: str) -> bool:
    return files.exists(spark, f"{root}/pointers")


def _read(spark: SparkSession, path: str) -> Pointer | None:
    text = files.read_text(spark, path)
    if text is None:
        return None
    held = json.loads(text)
    return Pointer(held["scope"], held["load"], tuple(held["replaces"]))


def _above(spark: SparkSession, root: str, scope: str) -> list[Pointer]:
    """Pointers of the scopes that hold this one, from the widest to its own."""
    parts = scope.split("/")
    found = (_read(spark, _pointer_file(root, "/".join(parts[:n]))) for n in range(1, len(parts) + 1))
    return [p for p in found if p is not None]


def _below(spark: SparkSession, root: str, scope: str) -> list[Pointer]:
    found = (_read(spark, path) for path in files.files_named(spark, f"{root}/pointers/{scope}", POINTER))
    return sorted((p for p in found if p is not None and p.scope != scope), key=lambda p: p.scope)


def _in_force(pointers: Sequence[Pointer]) -> list[Pointer]:
    return [p for p in pointers if not any(o.covers(p.scope) and p.load in o.replaces for o in pointers)]


def publish(spark: SparkSession, root: str, scope: str, load_id: str, cleanup: bool = True) -> str:
    """Make the rows that a load has written for a scope the published ones, in one put; returns their directory.

    What they replace is removed afterwards, a directory with one call each. ``cleanup=False`` leaves that to
    ``remove_unused``, for readers that may still be at work on the old rows.
    """
    above, below = _above(spark, root, scope), _below(spark, root, scope)
    pointer = Pointer(scope, load_id, tuple(p.load for p in below))
    files.put_text(spark, json.dumps(asdict(pointer)), _pointer_file(root, scope))
    if cleanup:
        for old in below:
            files.remove(spark, f"{root}/pointers/{old.scope}")
            files.remove(spark, version_dir(root, old.load))
        for old in above:
            if old.load != load_id:
                # The rows of a wider load outside this scope stay in force.
                wider = old.scope != scope
                files.remove(spark, f"{version_dir(root, old.load)}{f'/{scope}' if wider else ''}")
        files.remove(spark, f"{root}/data/{scope}")
    return f"{version_dir(root, load_id)}/{scope}"


def sources(spark: SparkSession, root: str, scope: str) -> list[Source]:
    """Where the published rows of a scope lie now; directories without a pointer are taken as they are."""
    plain = f"{root}/data"
    if not in_use(spark, root):
        return [Source(plain, (f"{plain}/{scope}",))]
    above, below = _above(spark, root, scope), _below(spark, root, scope)
    valid = _in_force([*above, *below])
    holding = [p for p in valid if p in above]
    inner = [p for p in valid if p in below]
    own = version_dir(root, holding[-1].load) if holding else plain
    rest = _without(spark, own, scope, [p.scope for p in inner])
    pointed = rest if holding else []
    for p in inner:
        pointed += _without(spark, version_dir(root, p.load), p.scope, [q.scope for q in inner if p.covers(q.scope)])
    found = [Source(plain, tuple(rest))] if rest and not holding else []
    return [*found, Source(f"{root}/versions", tuple(pointed))] if pointed else found


def _without(spark: SparkSession, base: str, scope: str, others: Sequence[str]) -> list[str]:
    """The directories that make up a scope but for others below it."""
    if not any(o.startswith(f"{scope}/") for o in others):
        return [f"{base}/{scope}"]
    found: list[str] = []
    for name in files.directories(spark, f"{base}/{scope}"):
        if f"{scope}/{name}" not in others:
            found += _without(spark, base, f"{scope}/{name}", others)
    return found


def remove_unused(spark: SparkSession, root: str) -> list[str]:
    """Remove the loads that no pointer in force names; returns their ids. Not while a load is being written."""
    pointers = [_read(spark, path) for path in files.files_named(spark, f"{root}/pointers", POINTER)]
    used = {p.load for p in _in_force([p for p in pointers if p is not None])}
    found = [name.removeprefix(f"{LOAD}=") for name in files.directories(spark, f"{root}/versions")]
    unused = sorted(load for load in found if load not in used)
    for load in unused:
        files.remove(spark, version_dir(root, load))
    return unused
