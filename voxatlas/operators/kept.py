"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Temporary folders of local sessions without the setting, by application.
_LOCAL: dict[str, str] = {}


def shared_path(spark: SparkSession) -> str:
    """A new path in the folder of spark.checkpoint.dir.

    Only a local session without the setting (a test) gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL:
            _LOCAL[application] = tempfile.mkdtemp(prefix="checkpoint-")
            atexit.register(shutil.rmtree, _LOCAL[application], ignore_errors=True)
        folder = _LOCAL[application]
    return f"{folder}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def kept(df: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again; ``paths`` gets where, to drop it once it has been used."""
    path = shared_path(df.sparkSession)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete kept tables; nothing may read them any more."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
