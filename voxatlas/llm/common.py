"""Small helpers of the operators: tables, hash groups, materialised steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """The fold that no model learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


#: Temporary folders of local sessions without the setting.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting (a test) gets a temporary folder, one for
    its application.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL:
            _LOCAL[application] = tempfile.mkdtemp(prefix="checkpoint-")
        folder = _LOCAL[application]
    return folder


#: Bits of a filter: 131,072 words, some megabytes for each task, whatever the data.
FILTER_BITS = 1 << 23
#: Tables that keep() has written, by the list that is collecting them now.
_COLLECTING: list[list[str]] = []


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read that instead.

    This cuts the lineage: a lost executor costs the tasks it ran, not what led to
    ``df``.  The table lives as long as the folder of its application, or until
    ``drop`` takes it away.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    for paths in _COLLECTING:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def kept() -> Iterator[list[str]]:
    """The tables that are kept within a block, so that they can be dropped once it has been used."""
    paths: list[str] = []
    _COLLECTING.append(paths)
    try:
        yield paths
    finally:
        _COLLECTING.pop()


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete kept tables; nothing may read them any more."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(hadoop).delete(path, True)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """``make()`` kept as a table, without the tables that were kept to make it."""
    with kept() as inside:
        out = make()
    out = keep(out)
    drop(out.sparkSession, inside)
    return out


def maybe_among(df: DataFrame, value: Column, keys: DataFrame, key: Column) -> DataFrame:
    """``df`` with _maybe: false only where ``value`` is none of ``keys``' values.

    The keys set bits of a filter of fixed size, which is safe to broadcast however
    many they are; a value whose bit another key has set passes too.  It spares rows a
    shuffle and decides nothing: an exact join follows.
    """
    bit = F.pmod(F.xxhash64(value), F.lit(FILTER_BITS))
    bits = keys.select(F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)).alias("_b")).groupBy(F.expr("cast(_b div 64 as int)").alias("_word")).agg(F.expr("bit_or(shiftleft(1L, cast(_b % 64 as int)))").alias("_bits"))
    marked = df.withColumn("_b", bit).withColumn("_word", F.expr("cast(_b div 64 as int)")).join(F.broadcast(bits), "_word", "left")
    return marked.withColumn("_maybe", F.expr("coalesce(getbit(_bits, cast(_b % 64 as int)) = 1, false)")).drop("_b", "_word", "_bits")


def groups_of(df: DataFrame, size, per_group: float) -> int:
    """How many groups of about ``per_group`` the sum of ``size`` makes; 1 at least.

    One narrow scan and one number, so that the group count follows the data at any
    scale and is the same whenever a lost task is run again.
    """
    total = df.agg(F.sum(size).alias("total")).head()[0] or 0
    return max(1, int(-(-total // per_group)))
