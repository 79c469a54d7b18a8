"""Jobs that end or fall silent, as a stream."""

import random
from datetime import datetime, timedelta, timezone

from hypothesis import given, settings, strategies as st

from quillon.streaming.expiry import Span, expiry_stream, merged_spans

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "batch_id string, seq long, job_state string, at timestamp"


def run(spark, tmp_path, waves):
    """Each wave is a run of its own that goes on from the checkpoint."""
    ended = None
    for wave in waves:
        spark.createDataFrame(wave, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "polls"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "polls"))
        ended = expiry_stream(
            stream, str(tmp_path / "ended"), str(tmp_path / "offsets"), timeout_seconds=60, delay_seconds=30)
    return {
        r.batch_id: (r.state, r.ended_ms, r.last_ms) for r in ended.selectExpr(
            "batch_id", "state", "unix_millis(ended_at) - 1704067200000 AS ended_ms",
            "unix_millis(last_poll_at) - 1704067200000 AS last_ms").collect()
    }


def poll(job, seq, state, second):
    return (job, seq, f"JOB_STATE_{state}", START + timedelta(seconds=second))


def test_ends_silences_and_restarts(spark, tmp_path):
    first = [
        poll("done", 1, "RUNNING", 0), poll("done", 3, "SUCCEEDED", 20), poll("tie", 2, "FAILED", 10),
        poll("tie", 1, "SUCCEEDED", 10), poll("silent", 1, "RUNNING", 0), poll("kept", 1, "RUNNING", 0),
        poll("kept", 1, "RUNNING", 0), (None, 1, "JOB_STATE_FAILED", START), ("nothing", 1, None, START),
        ("never", 1, "JOB_STATE_RUNNING", None), poll("early", 2, "FAILED", 25),
    ]
    # Out of order, but within the delay: the earlier end of "early" counts.
    second = [poll("kept", 2, "RUNNING", 50), poll("early", 1, "SUCCEEDED", 22), poll("clock", 1, "RUNNING", 50)]
    third = [poll("kept", 3, "RUNNING", 110), poll("silent", 2, "SUCCEEDED", 100), poll("clock", 2, "RUNNING", 110)]
    fourth = [poll("kept", 4, "CANCELLED", 170), poll("done", 9, "FAILED", 160), poll("clock", 3, "RUNNING", 170),
              poll("clock", 4, "RUNNING", 230)]
    assert run(spark, tmp_path, [first, second, third, fourth]) == {
        "done": ("SUCCEEDED", 20000, 20000),
        "tie": ("SUCCEEDED", 10000, 10000),
        "early": ("SUCCEEDED", 22000, 22000),
        "silent": ("EXPIRED", 60000, 0),
        "kept": ("FAILED", 170000, 170000),
    }


def test_no_polls(spark, tmp_path):
    assert run(spark, tmp_path, [[]]) == {}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.booleans()), min_size=1, max_size=25), st.randoms())
def test_spans_do_not_depend_on_the_order(polls, seeded: random.Random):
    """Joining in any order and in pieces gives the runs of the sorted polls."""
    spans = [Span(t, t, t if end else None, i if end else None, "X" if end else None) for i, (t, end) in enumerate(polls)]
    whole = merged_spans(spans, 3)
    times = sorted(t for t, _ in polls)
    breaks = sum(b - a > 3 for a, b in zip(times, times[1:]))
    assert len(whole) == breaks + 1
    seeded.shuffle(spans)
    cut = seeded.randrange(len(spans) + 1)
    assert merged_spans([*merged_spans(spans[:cut], 3), *spans[cut:]], 3) == whole
