"""Jobs that end, or that fall silent, as a stream with event-time timers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quillon.operators.jobs import polled
from quillon.session import session_setting
from quillon.sources.epochs import read_epochs, write_epoch
from quillon.streaming.sink import run_available

ENDED_SCHEMA = "batch_id string, state string, ended_ms bigint, last_poll_ms bigint"
RUN_SCHEMA = "first bigint, last bigint, ended bigint, seq bigint, state string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Span:
    """Polls of one job without a silence longer than the timeout, and their first end."""

    first: int
    last: int
    ended: int | None
    seq: int | None
    state: str | None

    def joined(self, other: "Span") -> "Span":
        ends = [s for s in (self, other) if s.ended is not None]
        end = min(ends, key=lambda s: (s.ended, s.seq), default=self)
        return Span(min(self.first, other.first), max(self.last, other.last), end.ended, end.seq, end.state)

    @property
    def fields(self) -> tuple:
        return (self.first, self.last, self.ended, self.seq, self.state)


def merged_spans(spans: Iterable[Span], timeout_ms: int) -> list[Span]:
    """Spans in order of time, those at most ``timeout_ms`` apart joined.

    The result is the same whatever the order in which polls arrive.
    """
    out: list[Span] = []
    for span in sorted(spans, key=lambda s: s.first):
        if out and span.first - out[-1].last <= timeout_ms:
            out[-1] = out[-1].joined(span)
        else:
            out.append(span)
    return out


class JobExpiry(StatefulProcessor):
    """One row per job once the watermark has passed its end or its deadline.

    State of a live job: its spans, which are at most the watermark's delay divided by the
    timeout, and a few, however many polls arrive. Of an ended job one flag stays, so later
    polls change nothing.
    """

    #: Polls of one job that are held before they are joined.
    HELD = 1000

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getListState("spans", RUN_SCHEMA)
        self.done = handle.getValueState("done", "ended boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.done.exists():
            return iter([])
        spans = [Span(*s) for s in self.spans.get()] if self.spans.exists() else []
        for row in rows:
            at = row.at_ms
            spans.append(Span(at, at, at, row.seq, row.state) if row.terminal else Span(at, at, None, None, None))
            if len(spans) >= self.HELD:
                spans = merged_spans(spans, self.timeout_ms)
        return self._settle(key, merged_spans(spans, self.timeout_ms), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.done.exists():
            return iter([])
        spans = [Span(*s) for s in self.spans.get()]
        return self._settle(key, spans, timerValues.getCurrentWatermarkInMs())

    def _settle(self, key, spans: list[Span], watermark: int) -> Iterator[Row]:
        """Report the job if its fate lies behind the watermark, else wait for that time."""
        first = spans[0]
        silent = first.last + self.timeout_ms
        at, state, last = (
            (silent, "EXPIRED", first.last) if first.ended is None else (first.ended, first.state, first.ended)
        )
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if at < watermark:
            self.spans.clear()
            self.done.update((True,))
            return iter([Row(batch_id=key[0], state=state, ended_ms=at, last_poll_ms=last)])
        self.spans.put([s.fields for s in spans])
        self.handle.registerTimer(at + 1)
        return iter([])


def expiry_stream(
    polls: DataFrame, path: str, checkpoint: str, *, timeout_seconds: int, delay_seconds: int
) -> DataFrame:
    """Jobs that have ended so far (batch_id, state, ended_at, last_poll_at).

    ``polls`` is a stream of (batch_id, seq, job_state, at). A job ends with its first
    terminal state (of two at the same millisecond the lower ``seq``), or is EXPIRED
    ``timeout_seconds`` after a poll that none followed in time; later polls of it are
    ignored. Both are reported once polls up to that time can no longer arrive, that is
    ``delay_seconds`` behind the newest poll; polls that arrive later than that are
    dropped. Jobs still waited for give no row. Polls without batch, state, number or time are
    left out. Timers and state live in the checkpoint, so a restart goes on where the last
    epoch ended, and a repeated epoch replaces its own folder.
    """
    spark: SparkSession = polls.sparkSession
    usable = polled(polls.dropna(subset=["batch_id", "job_state", "at", "seq"]))
    timed = usable.select(
        "batch_id", F.col("seq").cast("long").alias("seq"), "state", "terminal",
        F.unix_millis("at").alias("at_ms"), F.timestamp_millis(F.unix_millis("at")).alias("at"),
    ).withWatermark("at", f"{delay_seconds} seconds")
    ended = timed.groupBy("batch_id").transformWithState(
        JobExpiry(1000 * timeout_seconds), ENDED_SCHEMA, "append", "eventTime"
    )

    def each(changed: DataFrame, epoch: int) -> None:
        write_epoch(changed, path, epoch)

    # Timers need the state store that is kept on disk.
    with session_setting(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB):
        run_available(ended, each, checkpoint)
    return read_epochs(spark, path, ENDED_SCHEMA).select(
        "batch_id", "state", F.timestamp_millis("ended_ms").alias("ended_at"),
        F.timestamp_millis("last_poll_ms").alias("last_poll_at"),
    )
