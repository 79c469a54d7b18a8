import random

import pytest
from pyspark.sql import functions as F

from quillon.config import Limits
from quillon.operators import shards as sh
from quillon.operators import state as st
from quillon.operators.batches import as_batch_events, fold_batches
from quillon.operators.jobs import job_board, latest_states, merge_states

STATE = list(st.STATE_COLUMNS)


def events(spark, entries):
    """entries: (record_id, seq, event, value)"""
    full = []
    for record, seq, event, value in entries:
        full.append((
            record, seq, event,
            value if event == "image" else None, "sha" if value == "ok" else None,
            value if event == "assign" else None, value if event in ("submit", "reset") else None,
        ))
    return spark.createDataFrame(full, st.EVENT_SCHEMA)


def replay(entries):
    """Plain sequential replay."""
    found = {}
    for record, seq, event, value in sorted(entries, key=lambda e: e[1]):
        s = found.setdefault(record, dict(
            record_id=record, image_status="pending", image_sha=None, embed_status="pending",
            embed_attempts=0, batch_id=None, shard_id=None, upsert_status="pending"))
        s["updated_seq"] = seq
        if event == "image":
            s.update(image_status=value, image_sha="sha" if value == "ok" else None)
        elif event == "assign":
            s.update(embed_status="in_batch", shard_id=value)
        elif event == "submit":
            s["batch_id"] = value
        elif event == "embed_ok":
            s["embed_status"] = "ok"
        elif event == "embed_failed":
            s.update(embed_status="failed", embed_attempts=s["embed_attempts"] + 1)
        elif event == "reset":
            s.update(embed_status="pending", batch_id=None, shard_id=None, embed_attempts=s["embed_attempts"] + 1)
        elif event == "upsert":
            s["upsert_status"] = "ok"
    return sorted((tuple(s[c] for c in STATE) for s in found.values()), key=repr)


def random_log(seed, n=400):
    rng = random.Random(seed)
    values = {"image": ["ok", "failed_404", "failed_other"], "assign": [1, 2, 3], "submit": ["b1", "b2"]}
    log = []
    for seq in range(n):
        event = rng.choice(["insert", "image", "assign", "submit", "embed_ok", "embed_failed", "reset", "upsert"])
        # One record takes a third of all events.
        record = "hot" if rng.random() < 0.34 else f"r{rng.randrange(40)}"
        log.append((record, seq, event, rng.choice(values.get(event, ["b1"]))))
    return log


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_equals_replay(spark, rows, seed):
    log = random_log(seed)
    assert rows(st.fold_events(events(spark, log)).select(*STATE)) == replay(log)


@pytest.mark.parametrize("cut", [0, 150, 400])
def test_increments_equal_one_fold(spark, rows, cut):
    log = [(r, q, e, v) for r, q, e, v in random_log(3)]
    first = {r: q for r, q, *_ in reversed(log)}
    log = [(r, q, "insert" if first[r] == q else e, v) for r, q, e, v in log]
    state = st.fold_events(events(spark, log[:cut]))
    assert rows(st.apply_events(state, events(spark, log[cut:])).select(*STATE)) == replay(log)


def test_unknown_records_are_ignored(spark):
    log = events(spark, [("a", 1, "insert", None), ("b", 1, "embed_ok", None)])
    assert [r.record_id for r in st.fold_events(log, require_insert=True).collect()] == ["a"]
    known = st.fold_events(events(spark, [("a", 1, "insert", None)]))
    assert st.apply_events(known, events(spark, [("b", 2, "embed_ok", None)])).count() == 1


def state_rows(spark, entries):
    ddl = ("record_id string, image_status string, embed_status string, embed_attempts int, "
           "batch_id string, shard_id bigint, upsert_status string")
    return spark.createDataFrame(entries, ddl)


def test_selections(spark):
    state = state_rows(spark, [
        ("a", "ok", "pending", 2, None, None, "pending"),
        ("b", "ok", "pending", 3, None, None, "pending"),
        ("c", "pending", "pending", 0, None, None, "pending"),
        ("d", "ok", "ok", 0, "b", 1, "pending"),
        ("e", "ok", "ok", 0, "b", 1, "ok"),
        ("f", "failed_404", "failed", 1, "b", 1, "pending"),
    ])

    def ids(df):
        return sorted(r.record_id for r in df.collect())

    assert ids(st.embeddable(state, "text")) == ["a", "c"]
    assert ids(st.embeddable(state, "image")) == ["a"]
    assert ids(st.embeddable(state, "multimodal")) == ["a"]
    assert ids(st.pending_images(state)) == ["c"]
    assert ids(st.upsert_pending(state)) == ["d"]
    assert tuple(st.status_counts(state).first()) == (6, 4, 1, 2, 1, 1)


def test_counts_of_nothing_are_zero(spark):
    assert tuple(st.status_counts(state_rows(spark, [])).first()) == (0, 0, 0, 0, 0, 0)


def test_reset_and_submit_reach_members(spark, rows):
    state = state_rows(spark, [
        ("a", "ok", "ok", 0, "b1", 1, "ok"), ("b", "ok", "in_batch", 1, "b1", 1, "pending"),
        ("c", "ok", "in_batch", 0, "b2", 2, "pending"), ("d", "ok", "in_batch", 0, None, 3, "pending"),
        ("e", "ok", "pending", 0, None, None, "pending"),
    ])
    failed = spark.createDataFrame([("b1", "EXPIRED")], "batch_id string, state string")
    reset = st.reset_events(state, st.failed_batches(failed), 9)
    assert rows(reset.select("record_id", "event", "seq")) == [("a", "reset", 9), ("b", "reset", 9)]
    after = {r.record_id: r for r in st.apply_events(
        state.withColumns({"image_sha": F.lit(None).cast("string"), "updated_seq": F.lit(1)}), reset).collect()}
    assert (after["a"].embed_status, after["a"].embed_attempts, after["a"].batch_id, after["a"].shard_id) == (
        "pending", 1, None, None)
    assert after["a"].upsert_status == "ok" and after["b"].embed_attempts == 2
    jobs = spark.createDataFrame([(3, "job")], "shard_id bigint, batch_id string")
    assert rows(st.submit_events(state, jobs, 9).select("record_id", "batch_id")) == [("d", "job")]


def test_cancel(spark, rows):
    batches = spark.createDataFrame([("x", "SUBMITTED"), ("y", "SUBMITTED")], "batch_id string, state string")
    gone = spark.createDataFrame([("x",), ("x",), ("z",)], "batch_id string")
    assert rows(st.cancel_batches(batches, gone)) == [("x", "FAILED"), ("y", "SUBMITTED")]


def test_batch_fold(spark):
    log = as_batch_events(spark.createDataFrame(
        [(1, "PENDING", 330, 1)], "shard_id bigint, state string, est_tokens bigint, record_count bigint"), 1)
    log = log.unionByName(as_batch_events(spark.createDataFrame(
        [(1, "SUBMITTED", "b")], "shard_id bigint, state string, batch_id string"), 2))
    log = log.unionByName(as_batch_events(spark.createDataFrame(
        [(1, "SUCCEEDED")], "shard_id bigint, state string"), 3))
    row = fold_batches(log).first()
    assert (row.state, row.batch_id, row.est_tokens, row.record_count) == ("SUCCEEDED", "b", 330, 1)


def test_terminal_state_sticks(spark, rows):
    polls = [
        ("a", 1, "JOB_STATE_PENDING"), ("a", 2, "JOB_STATE_RUNNING"),
        ("b", 1, "JOB_STATE_SUCCEEDED"), ("b", 2, "JOB_STATE_RUNNING"), ("b", 3, "JOB_STATE_FAILED"),
        ("c", 5, "what"),
    ]
    df = spark.createDataFrame(polls, "batch_id string, seq bigint, job_state string")
    expected = [("a", "RUNNING", 2, False), ("b", "SUCCEEDED", 1, True), ("c", "RUNNING", 5, False)]
    assert rows(latest_states(df)) == expected
    halves = latest_states(df.where("seq > 1")), latest_states(df.where("seq <= 1"))
    assert rows(merge_states(*halves)) == expected


def test_job_board(spark, rows):
    jobs = spark.createDataFrame(
        [("a", "shard-1", "JOB_STATE_RUNNING"), ("b", "shard-2", "JOB_STATE_FAILED")],
        "batch_id string, display_name string, job_state string")
    known = spark.createDataFrame([("a", "SUBMITTED"), (None, "PENDING")], "batch_id string, state string")
    assert [r[3] for r in rows(job_board(jobs, known))] == ["SUBMITTED", "—"]


# Shards.

LIMITS = Limits(records_per_shard=4, embedding_dim=2)


@pytest.mark.parametrize("n, sizes", [(0, []), (3, [3]), (4, [4]), (5, [4, 1])])
@pytest.mark.parametrize("base", [None, 6])
def test_chunks(spark, n, sizes, base):
    ids = spark.createDataFrame([(f"k{i}",) for i in range(n)], "record_id string")
    old = spark.createDataFrame([] if base is None else [(base,)], "shard_id bigint")
    assignment = sh.assign_shards(ids, old, LIMITS)
    got = sorted((r.shard_id, r.record_count, r.est_tokens) for r in sh.shard_batches(assignment, LIMITS).collect())
    start = 0 if base is None else base + 1
    assert got == [(start + i, s, s * 330) for i, s in enumerate(sizes)]
    ordered = [r.record_id for r in assignment.orderBy("shard_id", "record_id").collect()]
    assert ordered == sorted(ordered)


def first_fit(pending, running, slots, cap):
    taken, left = [], cap - sum(running)
    free = slots - len(running)
    for shard, tokens in pending:
        if len(taken) < free and tokens <= left:
            taken.append((shard, tokens))
            left -= tokens
    return taken


@pytest.mark.parametrize("seed", range(12))
def test_admission_equals_first_fit(spark, seed):
    rng = random.Random(seed)
    slots, cap = rng.choice([0, 1, 3, 9]), rng.choice([0, 1000, 5000, 20000])
    running = [rng.randrange(1, 8) * 330 for _ in range(rng.randrange(0, 4))]
    pending = [(i, rng.choice([1, 2, 3, 5, 8, 13, 80]) * 330) for i in range(rng.randrange(0, 60))]
    batches = [(i, "PENDING", t) for i, t in pending] + [(1000 + i, "SUBMITTED", t) for i, t in enumerate(running)]
    rng.shuffle(batches)
    df = spark.createDataFrame(batches, "shard_id bigint, state string, est_tokens bigint")
    limits = Limits(max_concurrent_jobs=slots, max_enqueued_tokens=cap)
    got = [(r.shard_id, r.est_tokens) for r in sh.admission_round(df, limits).orderBy("position").collect()]
    assert got == first_fit(pending, running, slots, cap)


def test_small_shard_passes_a_refused_one(spark):
    df = spark.createDataFrame([(1, "PENDING", 900), (2, "PENDING", 100)], "shard_id bigint, state string, est_tokens bigint")
    limits = Limits(max_enqueued_tokens=500)
    assert [r.shard_id for r in sh.admission_round(df, limits).collect()] == [2]
    assert [r.shard_id for r in sh.oversized_shards(df, limits).collect()] == [1]


def test_cost(spark):
    df = spark.createDataFrame([(50, 1)], "t int, i int")
    cost = sh.cost_estimate(df, tokens=F.col("t"), images=F.col("i"), token_rate=0.2e-6, image_rate=0.00012, discount=0.5)
    assert cost.first().cost == pytest.approx(0.000065)
