"""Tables that a job writes for itself, in a folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# One folder per application; Hadoop removes it when the driver's JVM ends.
_FOLDERS: dict[str, str] = {}


def session_folder(spark: SparkSession) -> str:
    """The application's folder below ``spark.checkpoint.dir``.

    Without that setting only a local session gets one, since executors elsewhere would not see the
    driver's temporary folder.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = f"{tempfile.gettempdir()}/sluicegate"
    root = f"{shared.rstrip('/')}/sluicegate-{context.applicationId}"
    if _FOLDERS.get(context.applicationId) != root:
        _FOLDERS[context.applicationId] = root
        path = context._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return root


def scratch(spark: SparkSession) -> str:
    """A new directory name in the application's folder."""
    return f"{session_folder(spark)}/{uuid.uuid4().hex}"


class Written:
    """The same rows, read back from a table in the shared folder: lineage ends, lost executors re-read."""

    def __init__(self, df: DataFrame):
        self.path = scratch(df.sparkSession)
        df.write.parquet(self.path)
        self.rows = df.sparkSession.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Remove the table, once nothing that is still to run reads it."""
        context = self.rows.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame) -> DataFrame:
    """The rows of a table that stays until the application ends."""
    return Written(df).rows
