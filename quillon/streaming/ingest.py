"""Incremental ingest with duplicate suppression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.config import DatasetSpec
from quillon.operators.dedupe import first_write_wins
from quillon.operators.normalize import normalize, split_null_ids
from quillon.session import materialize, session_setting
from quillon.sources.epochs import read_epochs, write_epoch
from quillon.streaming.history import KeyHistory
from quillon.streaming.sink import run_available

PARTITIONS = "spark.sql.shuffle.partitions"
#: Rows of an epoch that a task sorts.
TASK_ROWS = 500_000
RECORD_SCHEMA = "record_id string, point_id string, text string, image_url string, payload string"


def ingest_stream(
    rows: DataFrame, spec: DatasetSpec, path: str, checkpoint: str, order: Sequence[str] = ("text", "payload"),
    buckets: int = 32, blocks: int = 32,
) -> DataFrame:
    """Store each new record id once; returns the records table.

    The first epoch that brings an id wins, within an epoch the first row by ``order``
    (columns of the record). Rows without an id are left out. Ids seen before are found
    through ``KeyHistory`` (kept below ``path``, with its ``buckets`` and ``blocks``): an
    epoch reads the sieve and the buckets it can hit, not the stored records.
    """
    spark: SparkSession = rows.sparkSession
    columns = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]

    def each(batch: DataFrame, epoch: int) -> None:
        tasks = -(-batch.count() // TASK_ROWS)
        # A task sorts the rows it has read, and again those of its ids: both stay small.
        usable, _ = split_null_ids(normalize(batch.repartition(tasks) if tasks > 1 else batch, spec))
        parts = max(tasks, int(batch.sparkSession.conf.get(PARTITIONS)))
        with session_setting(batch.sparkSession, PARTITIONS, str(parts)):
            first = materialize(first_write_wins(usable.select(*columns), ["record_id"], list(order)), "arrived")
        history = KeyHistory(batch.sparkSession, f"{path}/history", buckets, blocks)
        known = history.known(first.select("record_id"), epoch)
        write_epoch(first.join(known.hint("shuffle_hash"), "record_id", "left_anti"), f"{path}/records", epoch)
        stored = read_epochs(batch.sparkSession, f"{path}/records", RECORD_SCHEMA)
        history.add(stored.where(F.col("epoch") == epoch).select("record_id"), epoch)

    run_available(rows, each, checkpoint)
    return read_epochs(spark, f"{path}/records", RECORD_SCHEMA)
