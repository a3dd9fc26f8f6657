"""A table of the latest row of each key, kept by the batches of a stream.

Keys are dealt out to a fixed number of buckets by hash. A batch rewrites the buckets that it touches, whole, under a version of its
own number: <path>/version=N/bucket_no=B. A bucket's rows are those of its greatest version whose write has ended. Nothing is changed in
place: a batch that fails leaves the table as it was, a batch that is repeated starts from the versions before its own, and what a
reader has found stays until `keep` later batches have rewritten a bucket of it. Versions beyond that are compacted away.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "bucket_no"


def _hadoop(spark: SparkSession, path: str):
    """(file system, path), of whatever kind the path's scheme names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _numbered(fs, path, prefix: str) -> list[int]:
    """The numbers N of the folders <prefix>N in a folder."""
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


class KeyedStore:
    """The newest row of each key. order: the columns by which rows of one key are compared; the greatest wins, and of equal ones that
    of the later batch (without columns, always the later batch's, and within a batch any of the key's). Null keys are keys like others."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: list[str] | None = None, buckets: int = 32, keep: int = 2):
        if BUCKET in schema.names or "is_new" in schema.names:
            raise ValueError(f"columns {BUCKET} and is_new are taken")
        if buckets < 1 or keep < 2:
            raise ValueError("a store has one bucket and keeps two versions of it at least")
        self.spark, self.path, self.schema, self.keys, self.order = spark, path.rstrip("/"), schema, keys, order or []
        self.buckets, self.keep = buckets, keep

    def versions(self, below: int | None = None) -> dict[int, list[int]]:
        """Of each bucket its versions, the newest first. below: only versions of lower numbers. A listing of buckets x (keep + 1)
        folders at most, once merges have compacted."""
        fs, root = _hadoop(self.spark, self.path)
        out: dict[int, list[int]] = defaultdict(list)
        if not fs.exists(root):
            return {}
        for number in reversed(_numbered(fs, root, "version=")):
            folder = _hadoop(self.spark, f"{self.path}/version={number}")[1]
            if (below is None or number < below) and fs.exists(_hadoop(self.spark, f"{self.path}/version={number}/_SUCCESS")[1]):
                for bucket in _numbered(fs, folder, f"{BUCKET}="):
                    out[bucket].append(number)
        return dict(out)

    def _load(self, below: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        found = self.versions(below)
        paths = [f"{self.path}/version={v[0]}/{BUCKET}={b}" for b, v in sorted(found.items()) if buckets is None or b in buckets]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """The table as it is now."""
        return self._load()

    def lookup(self, rows: DataFrame) -> DataFrame:
        """The buckets that hold the keys of rows, which has the key columns; other keys of these buckets come along."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return self._load(buckets=[r[0] for r in rows.select(bucket).distinct().collect()])  # self.buckets at most

    def _newest(self, rows: DataFrame, order: list) -> DataFrame:
        rest = [c for c in self.schema.names if c not in self.keys]
        newest = F.max_by(F.struct(*rest), F.struct(*order) if order else F.lit(0))
        return rows.groupBy(*self.keys).agg(newest.alias("newest_row")).select(*self.keys, "newest_row.*").select(self.schema.names)

    def merge(self, batch: DataFrame, number: int) -> None:
        """For foreachBatch. The batch is reduced to a row for each key first; only buckets that it touches are read and written."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        new = self._newest(batch.select(self.schema.names), self.order).persist()
        try:
            touched = [r[0] for r in new.select(bucket).distinct().collect()]  # self.buckets at most
            if not touched:
                return
            stored = self._load(number, touched).withColumn("is_new", F.lit(0)).unionByName(new.withColumn("is_new", F.lit(1)))
            merged = self._newest(stored, [*self.order, "is_new"]).withColumn(BUCKET, bucket)
            dealt = merged.repartition(len(touched), BUCKET)
            dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/version={number}")
        finally:
            new.unpersist()
        self.compact()

    def compact(self) -> None:
        """Removes versions of buckets that `keep` newer ones have replaced, and versions without buckets."""
        fs, _ = _hadoop(self.spark, self.path)
        used: dict[int, int] = defaultdict(int)
        for bucket, numbers in self.versions().items():
            for i, number in enumerate(numbers):
                used[number] += i < self.keep
                if i >= self.keep:
                    fs.delete(_hadoop(self.spark, f"{self.path}/version={number}/{BUCKET}={bucket}")[1], True)
        for number, left in used.items():
            if not left:
                fs.delete(_hadoop(self.spark, f"{self.path}/version={number}")[1], True)
