"""All submission rounds at once."""

import random

import pytest
from pyspark.sql import functions as F

from quillon.config import Limits
from quillon.operators.schedule import admission_schedule

SCHEMA = "shard_id long, batch_id string, state string, est_tokens long, record_count long, request_file string"


def batches(spark, sizes, state="PENDING"):
    return spark.createDataFrame([(s, None, state, t, 1, "f") for s, t in sizes], SCHEMA)


def walked(sizes, slots, budget):
    """Shard by shard."""
    out, number, jobs, left = [], 0, 0, budget
    for shard, tokens in sorted(sizes):
        tokens = max(tokens or 0, 0)
        if tokens > budget:
            continue
        if jobs == slots or tokens > left:
            number, jobs, left = number + 1, 0, budget
        jobs, left = jobs + 1, left - tokens
        out.append((shard, tokens, number))
    return out


@pytest.mark.parametrize("slots, budget, block", [(4, 30, 5), (1, 30, 1), (3, 9, 3), (9, 1000, 7_000)])
def test_rounds_equal_a_walk(spark, slots, budget, block):
    rng = random.Random(slots)
    sizes = [(3 * i + 1, rng.choice([0, 1, 5, 9, 10, 31, None, -2])) for i in range(83)]
    rng.shuffle(sizes)
    limits = Limits(max_concurrent_jobs=slots, max_enqueued_tokens=budget)
    done = batches(spark, [(1000, 5)], "SUCCEEDED")
    got = admission_schedule(batches(spark, sizes).unionByName(done), limits, block)
    assert sorted(tuple(r) for r in got.collect()) == walked(sizes, slots, budget)


def test_empty_and_impossible(spark):
    limits = Limits(max_concurrent_jobs=2, max_enqueued_tokens=10)
    assert admission_schedule(batches(spark, []), limits).count() == 0
    assert admission_schedule(batches(spark, [(1, 11)]), limits).count() == 0
    with pytest.raises(ValueError):
        admission_schedule(batches(spark, []), limits, block_size=1)
