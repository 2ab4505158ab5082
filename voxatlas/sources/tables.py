"""Tables in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxatlas.functions.scalar import natural_key

#: Fixed value: a column that mounted shares leave in tables.
SHARE_COLUMN = "smb-share:server"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(SHARE_COLUMN)


def write_parquet(df: DataFrame, path: str, overwrite: bool = True) -> DataFrame:
    """Write a table and return it as read from there, its lineage cut."""
    df.write.mode("overwrite" if overwrite else "error").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """One header a file, or none; columns of arrays and structs are not for this format."""
    df.write.mode("overwrite").option("header", header).csv(path)


def has_file(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a whole table is there: one whose writer has left its mark of success."""
    return has_file(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a table or file in any store; whether there was one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.exists(target) and store.getFileStatus(target).isDirectory()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders right below a path, in the natural order of their names."""
    import re

    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = [s.getPath().toString() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root) if s.isDirectory()]
    return sorted(found, key=lambda p: [int(t) if t.isdigit() else t for t in re.split(r"(\d+)", p)])


def matching_files(files: DataFrame, pattern: str) -> DataFrame:
    """Rows of a table of paths that have the pattern in them, with a key of their natural order."""
    return files.where(F.regexp_like("path", F.lit(pattern))).withColumn("natural_key", natural_key("path"))
