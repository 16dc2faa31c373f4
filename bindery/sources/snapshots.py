"""A keyed table as versions: an upsert rewrites only the buckets that it touches.

Rows lie in buckets by a hash of their key. A version is a manifest, bucket by bucket,
of the folder that holds its rows; it is written last and by one commit, so that a
reader sees a whole version or the one before, and a run that fails leaves files that
no version names. Folders of buckets never change; a new version names those of
the old one that were not touched. A manifest has one row a bucket, so its size is
bounded by the table's number of buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import delete, upsert

BUCKET = "_bucket"


class Snapshots:
    def __init__(self, spark: SparkSession, folder: str, keys: list[str], buckets: int = 64) -> None:
        self.spark, self.folder, self.keys, self.buckets = spark, folder.rstrip("/"), keys, buckets
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _children(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._system.listStatus(path)] if self._system.exists(path) else []

    def versions(self) -> list[int]:
        """All committed versions, the first is 1."""
        made = (v for v in self._children(f"{self.folder}/versions") if v.isdigit())
        return sorted(int(v) for v in made if self._system.exists(self._path(f"{self.folder}/versions/{v}/_SUCCESS")))

    def manifest(self, version: int | None = None) -> dict[int, str]:
        """bucket: folder with its rows."""
        version = version or max(self.versions(), default=0)
        return {r[BUCKET]: r["path"] for r in self.spark.read.parquet(f"{self.folder}/versions/{version}").collect()} if version else {}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in self.keys)), F.lit(self.buckets)).cast("int")

    def _rows(self, manifest: dict[int, str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*manifest.values()) if manifest else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """One whole version, the newest unless another is named."""
        known = self.versions()
        if not known:
            raise ValueError(f"{self.folder} has no version yet")
        schema = self.spark.read.parquet(f"{self.folder}/schema").schema
        return self._rows(self.manifest(version), schema)

    def _commit(self, manifest: dict[int, str]) -> int:
        """A version is committed once: a second writer of the same number fails, and has to start from the new one."""
        version = max(self.versions(), default=0) + 1
        rows = self.spark.createDataFrame(sorted(manifest.items()), f"{BUCKET} int, path string").coalesce(1)
        rows.write.mode("errorifexists").parquet(f"{self.folder}/versions/{version}")
        return version

    def _written(self, rows: DataFrame) -> dict[int, str]:
        folder = f"{self.folder}/data/{uuid.uuid4().hex}"
        rows.withColumn(BUCKET, self._bucket()).repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
        return {int(c.partition("=")[2]): f"{folder}/{c}" for c in self._children(folder) if c.startswith(f"{BUCKET}=")}

    def create(self, rows: DataFrame) -> int:
        rows.limit(0).write.mode("errorifexists").parquet(f"{self.folder}/schema")
        return self._commit(self._written(rows))

    def _changed(self, rows: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
        touched = {r[BUCKET] for r in rows.select(self._bucket().alias(BUCKET)).distinct().collect()}  # as many as there are buckets at most
        before = self.manifest()
        mine = {b: p for b, p in before.items() if b in touched}
        after = self._written(change(self._rows(mine, self.read().schema)))
        return self._commit({b: p for b, p in before.items() if b not in touched} | after)

    def upsert(self, rows: DataFrame, assign: dict[str, Column] | None = None) -> int:
        """A version with rows merged in by sinks.upsert, of which only touched buckets are read and written."""
        return self._changed(rows, lambda old: upsert(old, rows, self.keys, assign))

    def delete(self, rows: DataFrame) -> int:
        """A version without the keys of rows."""
        return self._changed(rows, lambda old: delete(old, rows, self.keys))

    def put_back(self, version: int) -> int:
        """A new version that is an old one again; no row is written."""
        return self._commit(self.manifest(version))
