"""Image fetch over URLs with an injected fetcher."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillon.config import Limits
from quillon.functions.requests import picture_type
from quillon.functions.states import GONE_CODES, TRANSIENT_ERRORS, fetch_status
from quillon.session import materialize


@dataclass(frozen=True)
class Response:
    """One try: an HTTP status, or the kind of error (timeout, network, protocol, other)."""

    status_code: int | None = None
    error_kind: str | None = None
    content: bytes | None = None

    @property
    def transient(self) -> bool:
        if self.status_code is not None and self.status_code >= 400:
            return self.status_code not in GONE_CODES
        return self.error_kind in TRANSIENT_ERRORS


Fetcher = Callable[[str], Response]
FETCH_SCHEMA = "url string, status_code int, error_kind string, attempts int, sha string, content binary"


def _wait(attempt: int) -> float:
    """Seconds before the next try: doubling from 2 up to 32."""
    return float(min(32, 2**attempt))


def fetch_urls(
    urls: DataFrame, make_fetcher: Callable[[], Fetcher], limits: Limits = Limits(),
    url_column: str = "image_url", partitions: int | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Fetch each distinct URL once: (url, status_code, error_kind, attempts, sha, content).

    Copies of a URL are merged before the fetch, and URLs are spread evenly over tasks that
    each run ``fetch_concurrency`` requests at a time. The outcome is written once, so
    nothing downstream fetches again.
    """
    spark = urls.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = urls.select(F.col(url_column).alias("url")).distinct().repartition(n, "url")
    tries, width = limits.fetch_attempts, limits.fetch_concurrency

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetcher = make_fetcher()

        def one(url: str):
            for attempt in range(1, tries + 1):
                response = fetcher(url) if url else Response(error_kind="other")
                if not response.transient or attempt == tries:
                    break
                sleep(_wait(attempt))
            sha = hashlib.sha256(response.content).hexdigest() if response.content is not None else None
            return url, response.status_code, response.error_kind, attempt, sha, response.content

        with ThreadPoolExecutor(width) as pool:
            for batch in batches:
                names = batch.column(0).to_pylist()
                # Contents of one group of requests are held at a time.
                for start in range(0, len(names), width):
                    rows = list(pool.map(one, names[start : start + width]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r[0] for r in rows], pa.string()),
                            pa.array([r[1] for r in rows], pa.int32()),
                            pa.array([r[2] for r in rows], pa.string()),
                            pa.array([r[3] for r in rows], pa.int32()),
                            pa.array([r[4] for r in rows], pa.string()),
                            pa.array([r[5] for r in rows], pa.binary()),
                        ],
                        names=["url", "status_code", "error_kind", "attempts", "sha", "content"],
                    )

    return materialize(distinct.mapInArrow(run, FETCH_SCHEMA), "fetched")


def fetched_ok() -> Column:
    """Whether a fetched row holds a picture."""
    status = fetch_status(F.col("status_code"), F.col("error_kind"))
    return (status == "ok") & picture_type(F.col("content")).isNotNull()


def fetch_outcomes(
    records: DataFrame, fetched: DataFrame, url_column: str = "image_url"
) -> DataFrame:
    """(record_id, image_status, image_sha, attempts) of every record.

    An answer that is no picture is a failure; so is a record without a URL, after no
    attempt. The outcomes are unique by URL; a URL shared by many records skews only the record
    side, which adaptive execution can split.
    """
    status = F.when(fetched_ok(), "ok").when(
        F.col("status_code") == 200, "failed_other"
    ).otherwise(fetch_status(F.col("status_code"), F.col("error_kind")))
    outcome = fetched.select(
        F.col("url").alias(url_column),
        status.alias("image_status"),
        F.when(status == "ok", F.col("sha")).alias("image_sha"),
        "attempts",
    )
    asked = records.select("record_id", url_column).join(outcome, url_column, "left")
    return asked.select(
        "record_id", F.coalesce("image_status", F.lit("failed_other")).alias("image_status"), "image_sha",
        F.coalesce("attempts", F.lit(0)).alias("attempts"),
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("image_status").agg(F.count(F.lit(1)).alias("n"))
