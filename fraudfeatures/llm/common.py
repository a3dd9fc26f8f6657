"""What the operators share: the shared work folder, frozen tables, fresh column names, the split by document id."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from types import ModuleType
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session. It must be set, because a folder of one
    machine's own would lose rows on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = f"file://{tempfile.mkdtemp(prefix='spark-')}"  # driver and executor are one process
    spark.conf.set("spark.checkpoint.dir", root)
    return root


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs within hand rows to Python in batches of 8 MB, so that wide rows do not fill a worker's memory."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "8m")
    try:
        yield
    finally:
        spark.conf.set(name, before)


_scratches: list[list[str]] = []  # the tables of each scratch that is open, the innermost last


def frozen(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: a lost executor cannot change rows or order after
    this, and what follows starts from the table instead of the lineage."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if _scratches:
        _scratches[-1].append(path)
    with small_batches(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables frozen within are removed at the end, but for those that are frozen by the function it gives: a result must not be read
    from anything else that was made within."""
    made: list[str] = []
    _scratches.append(made)

    def out(df: DataFrame, name: str) -> DataFrame:
        result = frozen(df, name)
        path = made.pop()
        if len(_scratches) > 1:
            _scratches[-2].append(path)
        return result

    try:
        yield out
    finally:
        _scratches.pop()
        for path in made:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def per_worker(key: tuple, make: Callable[[], T]) -> T:
    """What make() gives, made once in each Python worker and kept between its tasks until another thing is asked for. It is
    kept outside this package, because the functions of tasks travel by value."""
    kept = sys.modules.setdefault("worker_memory", ModuleType("worker_memory")).__dict__
    if key not in kept:
        forget_in_worker()
        kept[key] = make()
    return kept[key]


def forget_in_worker() -> None:
    """Lets go of what per_worker keeps, in tasks that have no use for it, and hands free memory back to the system: Spark keeps workers
    that wait, several for each core, and all of them count."""
    if "worker_memory" in sys.modules:
        sys.modules["worker_memory"].__dict__.clear()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        getattr(ctypes.CDLL(None), "malloc_trim", int)(0)  # glibc has it


def sampled(df: DataFrame, n: int, key: str) -> DataFrame:
    """n rows of df, or all if it has fewer: those of the smallest hashes of the key, which does not repeat. Of more, a share is
    drawn by the hash first, so that no task hands on n rows of its own."""
    draw, total = F.pmod(F.xxhash64(key), F.lit(2**31)), df.count()
    if total > 2 * n:
        df = df.where(draw < int(2**31 * min(1.0, (n + 6 * n**0.5 + 50) / total)))
    return df.orderBy(draw, key).limit(n)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not use, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def crc32_of_id(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))


def is_held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4 is 2; a null id is not held out and never trained on either."""
    return F.coalesce(F.pmod(crc32_of_id(doc_id), F.lit(4)) == 2, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
