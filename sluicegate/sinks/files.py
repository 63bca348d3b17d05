"""Directories on any Hadoop file system. No row passes through here."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# File systems whose rename copies every byte; data is rewritten there by tasks instead.
COPY_ON_RENAME = frozenset({"s3", "s3a", "s3n", "gs", "oss", "cosn", "wasb", "wasbs"})


def first_data_file(spark: SparkSession, path: str) -> str | None:
    """A Parquet file below the path, the first that a listing meets; none where there is no such file."""
    fs, jpath = _resolve(spark, path)
    if not fs.exists(jpath):
        return None
    listing = fs.listFiles(jpath, True)
    while listing.hasNext():
        name = listing.next().getPath().toString()
        if name.endswith(".parquet"):
            return name
    return None


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet file lies below the path; stops at the first one."""
    return first_data_file(spark, path) is not None


def files_named(spark: SparkSession, path: str, name: str) -> list[str]:
    """All files of one name below a path; none where it does not exist."""
    fs, jpath = _resolve(spark, path)
    found: list[str] = []
    if fs.exists(jpath):
        listing = fs.listFiles(jpath, True)
        while listing.hasNext():
            at = listing.next().getPath()
            if at.getName() == name:
                found.append(at.toString())
    return found


def directories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly below a path, but for hidden ones."""
    fs, jpath = _resolve(spark, path)
    if not fs.exists(jpath):
        return []
    found = [status.getPath().getName() for status in fs.listStatus(jpath) if status.isDirectory()]
    return [name for name in found if not name.startswith((".", "_temporary", "_spark"))]


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below a path; none where it does not exist."""
    fs, jpath = _resolve(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(jpath)] if fs.exists(jpath) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _resolve(spark, path)
    return fs.exists(jpath)


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _resolve(spark, path)
    fs.delete(jpath, True)


def renames_in_place(spark: SparkSession, source: str, target: str) -> bool:
    """Whether moving a directory is one cheap step: same file system, and not an object store."""
    origin, place = (_resolve(spark, path)[0].getUri() for path in (source, target))
    return origin.equals(place) and place.getScheme() not in COPY_ON_RENAME


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, jtarget = _resolve(spark, target)
    fs.mkdirs(jtarget.getParent())
    if not fs.rename(_path(spark, source), jtarget):
        raise OSError(f"could not rename {source} to {target}")


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """Write one small file, replacing an older one."""
    fs, jpath = _resolve(spark, path)
    stream = fs.create(jpath, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def put_text(spark: SparkSession, text: str, path: str) -> None:
    """Replace one small file in one step: a reader finds the old text or the new one.

    Object stores show a file when it is complete. Elsewhere it is written aside and renamed over the old one.
    """
    fs, jpath = _resolve(spark, path)
    if fs.getUri().getScheme() in COPY_ON_RENAME:
        write_text(spark, text, path)
        return
    aside = f"{path}.{uuid.uuid4().hex}"
    write_text(spark, text, aside)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(_path(spark, aside), jpath, how)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of one small file; none where it does not exist."""
    fs, jpath = _resolve(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def replace_directory(spark: SparkSession, staged: str, target: str, retired: str) -> None:
    """Put ``staged`` in the place of ``target``.

    The old directory steps aside first and comes back if the new one cannot move in,
    so a failure never leaves the scope empty. Once it is out of use it is for the caller
    to remove.
    """
    had_old = exists(spark, target)
    if had_old:
        remove(spark, retired)
        rename(spark, target, retired)
    try:
        rename(spark, staged, target)
    except Exception:
        if had_old:
            rename(spark, retired, target)
        raise


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _resolve(spark: SparkSession, path: str):
    jpath = _path(spark, path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath
