"""The points table: vectors with payloads, keyed by point id."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillon.config import INDEX_TYPES, SpecError
from quillon.functions.vectors import sign_sketch
from quillon.operators.state import as_events, upsert_pending
from quillon.session import materialize
from quillon.sources.bucketed import BucketedLog
from quillon.sources.epochs import read_epochs, write_epoch

log = logging.getLogger(__name__)

POINT_COLUMNS = ("point_id", "record_id", "vector", "payload")
POINT_SCHEMA = "point_id string, record_id string, vector array<float>, payload string"
UUID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def points_to_upsert(
    state: DataFrame, records: DataFrame, vectors: DataFrame, order: list[str]
) -> DataFrame:
    """Points of records that are embedded but not yet stored; the last vector wins.

    ``order`` must be total within a record. Which vector wins is found on keys alone, of
    pending records alone, and the winners meet the vectors by record: over vectors that
    are bucketed by record no vector crosses an exchange. Both sides of every join grow with
    the records, so none is broadcast through the driver, however small its files look.
    """
    pending = upsert_pending(state).select("record_id").hint("merge")
    keys = vectors.select("record_id", F.struct(*order).alias("_place")).join(pending, "record_id", "left_semi")
    wanted = keys.groupBy("record_id").agg(F.max("_place").alias("_last")).join(
        records.select("record_id", "point_id", "payload").hint("merge"), "record_id")
    placed = vectors.select("record_id", "vector", F.struct(*order).alias("_place"))
    # Not an equality, so that the record stays the only join key and its buckets serve.
    met = placed.join(wanted.hint("shuffle_hash"), "record_id").where("_place >= _last")
    return met.select(*POINT_COLUMNS)


def upsert_skipped(state: DataFrame, vectors: DataFrame) -> DataFrame:
    """Pending records without any vector."""
    return upsert_pending(state).join(vectors.select("record_id").hint("merge"), "record_id", "left_anti")


def upsert_points(points: DataFrame, incoming: DataFrame) -> DataFrame:
    """New snapshot: incoming points replace those with the same id."""
    kept = points.join(incoming.select("point_id").hint("merge"), "point_id", "left_anti")
    return kept.unionByName(incoming)


def upsert_events(incoming: DataFrame, seq: int) -> DataFrame:
    return as_events(incoming.select(
        "record_id", F.lit(seq).alias("seq"), F.lit("upsert").alias("event")
    ))


class PointStore:
    """Versions of points, bucketed by record, with a list of what later versions replace.

    A record's point id is computed from its id, so a record has one point. An upsert
    writes its points as a version and the keys (record_id, version) that it supersedes as
    a second, narrow table. Reading leaves superseded rows out by their keys: the points
    stay in their buckets and no vector is moved or sorted.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.log = BucketedLog(spark, f"{path}/versions", POINT_SCHEMA, "record_id", buckets)
        self._dead = f"{path}/superseded"

    def _superseded(self, versions: Collection[int]) -> DataFrame:
        rows = read_epochs(self.log.spark, self._dead, "record_id string, version bigint")
        rows = rows.where(F.col("epoch").isin(sorted(versions)))
        return rows.groupBy("record_id").agg(F.max("version").alias("_dead"))

    def _live(self, versions: Collection[int], *columns: str) -> DataFrame:
        stored = self.log.read(versions).select(*columns, "epoch")
        dead = self._superseded(versions).withColumnRenamed("record_id", "_record").hint("shuffle_hash")
        gone = (F.col("record_id") == F.col("_record")) & (F.col("epoch") <= F.col("_dead"))
        return stored.join(dead, gone, "left_anti")

    def write(self, incoming: DataFrame, version: int, earlier: Collection[int]) -> DataFrame:
        """Store one upsert over the ``earlier`` versions; running it again replaces it.

        Returns its keys as written (record_id).
        """
        self.log.write(incoming, version)
        written = self.log.read([version]).select("record_id")
        older = self._live(earlier, "record_id").join(written.hint("merge"), "record_id", "left_semi")
        write_epoch(older.select("record_id", F.col("epoch").alias("version")), self._dead, version)
        return written

    def current(self, versions: Collection[int]) -> DataFrame:
        """The newest point of every record among the given versions."""
        return self._live(versions, *POINT_COLUMNS).select(*POINT_COLUMNS)



def write_typed_points(
    points: DataFrame, path: str, indexes: Mapping[str, str], partition_by: Sequence[str] = ()
) -> None:
    """Store points with their typed payload fields as columns.

    Filters on these columns reach the scan; ``partition_by`` names keyword fields of few
    values, whose filters skip whole folders.
    """
    typed_payload(points, indexes).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


Writer = Callable[[list[dict]], None]
UPSERT_CHUNK, UPSERT_TRIES = 256, 3


def deliver_points(
    points: DataFrame, make_writer: Callable[[], Writer], chunk: int = UPSERT_CHUNK,
    tries: int = UPSERT_TRIES,
) -> DataFrame:
    """Hand points to an external store; returns (point_id, record_id, delivered), written once.

    Every task opens its own writer and sends chunks of point_id, vector and payload. A
    chunk that keeps failing is reported as not delivered and stays pending; a repeated
    task sends the same ids again, which an upsert by id absorbs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = make_writer()
        for whole in batches:
            for start in range(0, whole.num_rows, chunk):
                batch = whole.slice(start, chunk)
                rows = batch.select(["point_id", "vector", "payload"]).to_pylist()
                sent = False
                for _ in range(tries):
                    try:
                        write(rows)
                        sent = True
                        break
                    except Exception as problem:  # a store may fail in any way
                        log.warning("chunk of %d points failed: %s", len(rows), problem)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("point_id"), batch.column("record_id"), pa.array([sent] * len(rows), pa.bool_())],
                    names=["point_id", "record_id", "delivered"],
                )

    sent = points.select(*POINT_COLUMNS).mapInArrow(
        run, "point_id string, record_id string, delivered boolean"
    )
    return materialize(sent, "delivered")


def with_sketch(points: DataFrame, dim: int, vector: str = "vector") -> DataFrame:
    """Add the packed sign bits, a 32nd of the vector's size, as their own column."""
    return points.withColumn("sketch", sign_sketch(F.col(vector), dim))


def _typed(value: Column, kind: str) -> Column:
    """Payload field as its index type; values that do not fit become null."""
    if kind == "integer":
        return value.try_cast("bigint")
    if kind == "float":
        return value.try_cast("double")
    if kind == "bool":
        return value.try_cast("boolean")
    if kind == "datetime":
        return F.try_to_timestamp(value)
    if kind == "uuid":
        return F.when(value.rlike(UUID_PATTERN), F.lower(value))
    if kind == "geo":
        return F.from_json(value, "lon double, lat double")
    return value


def typed_payload(
    points: DataFrame, indexes: Mapping[str, str], payload: str = "payload"
) -> DataFrame:
    """Add one typed column per indexed payload field, named as the field.

    The payload is parsed once for all fields; unindexed fields are never built.
    """
    for name, kind in indexes.items():
        if kind not in INDEX_TYPES:
            raise SpecError(
                f"Unknown index type {kind!r} for field {name!r}. Supported: {list(INDEX_TYPES)}"
            )
    taken = [name for name in indexes if name in points.columns]
    if taken:
        raise SpecError(f"indexed fields named like columns of the points: {taken}")
    if not indexes:
        return points
    schema = ", ".join(f"`{name}` string" for name in indexes)
    parsed = points.withColumn("_fields", F.from_json(payload, schema))
    typed = {name: _typed(F.col(f"_fields.`{name}`"), kind) for name, kind in indexes.items()}
    return parsed.withColumns(typed).drop("_fields")
