"""Versioned state by key for ``foreachBatch`` streams: bucketed, with a manifest.

One row a key.  Keys are hashed to a fixed number of buckets; version ``v``
holds new folders for the buckets that its batch touches only,

    state/v=<v>/bucket=<b>/...

and a manifest, written last, that names for every bucket the version whose
folder holds it:

    manifest/v=<v>/...   (bucket, version), at most one row a bucket

Readers follow the manifest, so a batch that fails before its manifest is
written changes nothing, and a batch that is run again rewrites the same
version.  Bytes written follow the touched buckets, not the state.  The number
of buckets is read from the first manifest: a restart with another setting
goes on with the stored one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "bucket"


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _folder(spark, path)
    return fs.exists(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = _folder(spark, path)
    fs.delete(target, True)


class KeyState:
    """The state of a stream under ``path``, keyed by the column ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 256):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.buckets = buckets

    def _manifest(self, version: int) -> tuple[int, dict[int, int]]:
        """(number of buckets, version of each bucket that has rows)."""
        if version < 0:
            return self.buckets, {}
        rows = self.spark.read.parquet(f"{self.path}/manifest/v={version}").collect()  # one row a bucket
        return rows[0]["buckets"], {r["bucket"]: r["version"] for r in rows if r["bucket"] is not None}

    def bucket_of(self, count: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(count)).cast("int")

    def touched(self, batch: DataFrame, version: int) -> list[int]:
        """The buckets of a batch's keys, by the manifest before ``version``."""
        count, _ = self._manifest(version - 1)
        return sorted(r[0] for r in batch.select(self.bucket_of(count)).distinct().collect())  # at most one row a bucket

    def read(self, version: int, buckets: list[int] | None = None) -> DataFrame | None:
        """State after ``version``, all of it or some buckets; None without any row."""
        _, held = self._manifest(version)
        wanted = {b: v for b, v in held.items() if buckets is None or b in set(buckets)}
        if not wanted:
            return None
        by_version: dict[int, list[int]] = {}
        for b, v in wanted.items():
            by_version.setdefault(v, []).append(b)
        out = None
        for v, bs in sorted(by_version.items()):
            part = self.spark.read.parquet(*[f"{self.path}/state/v={v}/{BUCKET}={b}" for b in sorted(bs)])
            out = part if out is None else out.unionByName(part)
        return out

    def write(self, rows: DataFrame, version: int, touched: list[int]) -> None:
        """``rows``: all rows of the touched buckets after this version."""
        count, held = self._manifest(version - 1)
        folder = f"{self.path}/state/v={version}"
        by_bucket = rows.withColumn(BUCKET, self.bucket_of(count)).repartition(BUCKET)
        by_bucket.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        written = {r[0] for r in self.spark.read.parquet(folder).select(BUCKET).distinct().collect()} if touched else set()
        now = {b: v for b, v in held.items() if b not in set(touched)} | dict.fromkeys(written, version)
        entries = [(count, b, v) for b, v in sorted(now.items())] or [(count, None, None)]
        (self.spark.createDataFrame(entries, "buckets int, bucket int, version int").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/manifest/v={version}"))
        self._clean(version, held, now)

    def _clean(self, version: int, before: dict[int, int], now: dict[int, int]) -> None:
        """Bucket folders that neither this manifest nor the one before names,
        and the manifest before that (a replay needs the last one only)."""
        old = f"{self.path}/manifest/v={version - 2}"
        if version < 2 or not folder_exists(self.spark, old):  # a replay finds it gone
            return
        _, older = self._manifest(version - 2)
        for b, v in older.items():
            if before.get(b) != v and now.get(b) != v:
                remove_folder(self.spark, f"{self.path}/state/v={v}/{BUCKET}={b}")
        remove_folder(self.spark, old)
