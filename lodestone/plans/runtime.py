"""Where checkpoints and intermediate tables go."""

import tempfile
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of the session.

    ``spark.checkpoint.dir`` names the shared folder on a cluster. Only a local
    session without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lodestone-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A folder for intermediate tables of this application, next to its checkpoints."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "tables", spark.sparkContext.applicationId, *parts])


def hadoop_path(spark: SparkSession, path: str):
    """A path and the file system that holds it; the one place that reaches for Hadoop's API."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


_scope: ContextVar[list | None] = ContextVar("lodestone_scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Removes, at its end, the intermediate tables that were stored inside it.

    What an operator returns may still read its intermediate tables, so write the result
    before the scope ends. Scopes nest; a table belongs to the innermost one. Without a
    scope, tables stay until :func:`clear_scratch` or with the session's folder.
    """
    owned: list = []
    token = _scope.set(owned)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in owned:
            remove_folder(spark, path)


def own_scratch(path: str) -> str:
    """Hand a folder to the current scope, if there is one."""
    owned = _scope.get()
    if owned is not None:
        owned.append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> bool:
    folder, files = hadoop_path(spark, path)
    return files.delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; nothing may read them any more."""
    remove_folder(spark, scratch_path(spark))


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder and read back, so that its plan is run once."""
    path = own_scratch(scratch_path(df.sparkSession, f"{name}-{uuid4().hex}"))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
