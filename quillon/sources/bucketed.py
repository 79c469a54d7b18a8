"""Append-only tables whose files are bucketed and sorted by a key.

Joins and aggregations on the key read them without an exchange. Each epoch is a folder of
its own, as in ``epochs``; a session sees the folder as a table it registers on first use.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T


class BucketedLog:
    """Rows of ``schema`` in ``buckets`` buckets of ``key``, by epoch.

    The number of buckets belongs to the folder and must not change once it holds rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: str, buckets: int):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self._table = "quillon_" + hashlib.md5(f"{self.path}|{buckets}".encode()).hexdigest()
        self._known: set[int] | None = None

    def _folder(self, epoch: int) -> str:
        return f"{self.path}/epoch={epoch}"

    def write(self, rows: DataFrame, epoch: int) -> None:
        """Store one epoch; a repeated one replaces itself.

        Rows that aren't partitioned by the key's buckets yet cross one exchange, so that a
        bucket is one file.
        """
        name = f"quillon_{uuid.uuid4().hex}"
        try:
            rows.select(self.schema.names).write.mode("overwrite").format("parquet").bucketBy(
                self.buckets, self.key).sortBy(self.key).option("path", self._folder(epoch)).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay
        if self._known is not None:
            self.spark.catalog.refreshTable(self._table)

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows partitioned as the buckets are."""
        return rows.repartition(self.buckets, self.key)

    def read(self, epochs: Iterable[int]) -> DataFrame:
        """Rows of the given epochs with their ``epoch``."""
        wanted = set(epochs)
        if self._known is None:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._table} ({columns}, epoch BIGINT) USING parquet PARTITIONED BY (epoch) "
                f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
            self._known = {int(r[0].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self._table}").collect()}
        if new := sorted(wanted - self._known):
            parts = " ".join(f"PARTITION (epoch={e}) LOCATION '{self._folder(e)}'" for e in new)
            self.spark.sql(f"ALTER TABLE {self._table} ADD IF NOT EXISTS {parts}")
            self._known |= wanted
        stored = self.spark.table(self._table)
        return stored.where(stored["epoch"].isin(sorted(wanted))) if wanted else stored.limit(0)
