"""All submission rounds of the waiting shards at once."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillon.config import Limits
from quillon.operators.numbering import global_index
from quillon.operators.state import pending_shards
from quillon.session import materialize

#: Shards a task follows at a time.
BLOCK = 100_000


def next_rounds(tokens: np.ndarray, slots: int, budget: int) -> np.ndarray:
    """For each shard, the first one that doesn't fit into a round starting there."""
    spent = np.concatenate([[0], np.cumsum(tokens)])
    n = len(tokens)
    full = np.searchsorted(spent, spent[:-1] + budget, side="right") - 1
    return np.minimum(np.minimum(full, np.arange(n) + slots), n)


def _block(table: pa.Table, block_size: int) -> tuple[int, pa.Table, int]:
    """A block's number, its rows in order (with those it looks ahead to), and its own count."""
    table = table.sort_by("place")
    block = table["block"][0].as_py()
    own = int(np.count_nonzero(table["place"].to_numpy() < (block + 1) * block_size))
    return block, table, own


def _exits(table: pa.Table, slots: int, budget: int, block_size: int) -> pa.Table:
    """For each shard at which the first round of a block may start: the rounds that start
    in the block, and how far the last of them reaches beyond it."""
    block, table, own = _block(table, block_size)
    after = next_rounds(table["est_tokens"].to_numpy(), slots, budget)
    rounds, beyond = np.zeros(own, np.int64), np.zeros(own, np.int64)
    for at in range(own - 1, -1, -1):
        to = after[at]
        rounds[at], beyond[at] = (1, to - own) if to >= own else (rounds[to] + 1, beyond[to])
    starts = min(slots, own)
    return pa.table({
        "block": pa.array(np.full(starts, block), pa.int64()),
        "entry": pa.array(np.arange(starts), pa.int32()),
        "rounds": pa.array(rounds[:starts], pa.int64()),
        "beyond": pa.array(beyond[:starts], pa.int32()),
    })


def _followed(batches, schema: pa.Schema):
    """Entry and round at which each block is entered, from the blocks' exits in order."""
    entry, number, pending, block = 0, 0, {}, None
    out: list[tuple[int, int, int]] = []

    def leave():
        nonlocal entry, number
        out.append((block, entry, number))
        rounds, entry = pending.get(entry, (0, 0))
        number += rounds

    for batch in batches:
        for row in batch.to_pylist():
            if block is not None and row["block"] != block:
                leave()
                pending = {}
            block = row["block"]
            pending[row["entry"]] = (row["rounds"], row["beyond"])
    if block is not None:
        leave()
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else
                                     [pa.array([], f.type) for f in schema], schema=schema)


def _numbered(table: pa.Table, slots: int, budget: int, block_size: int) -> pa.Table:
    """Round of each shard of a block, from the shard and round at which it is entered."""
    _, table, own = _block(table, block_size)
    after = next_rounds(table["est_tokens"].to_numpy(), slots, budget)
    at, number = table["entry"][0].as_py(), table["number"][0].as_py()
    # Shards before the entry belong to the round that began in the block before.
    rounds = np.full(own, number - 1, np.int64)
    while at < own:
        rounds[at : after[at]] = number
        at, number = after[at], number + 1
    kept = table.slice(0, own)
    return pa.table({"shard_id": kept["shard_id"], "est_tokens": kept["est_tokens"], "round": pa.array(rounds, pa.int64())})


def admission_schedule(batches: DataFrame, limits: Limits = Limits(), block_size: int = BLOCK) -> DataFrame:
    """(shard_id, est_tokens, round): every pending shard's round, from 0, when rounds follow
    one another and each waits for the one before.

    Shards are taken in order of their ids; a round ends where the next shard exceeds its
    slots or tokens, so none overtakes another (``admission_round`` lets small ones pass).
    Shards no round can take are left out (``oversized_shards``). Shards without an
    estimate count nothing; shard ids must be unique and not null.

    A round reaches at most ``slots`` - 1 shards into the next block of ``block_size``
    shards. Each block therefore tells, for its first ``slots`` shards, where rounds that
    start there leave it; one task follows these few rows per block, and the blocks then number
    their shards. The jobs are as many whatever the number of shards or rounds.
    """
    slots, budget = limits.max_concurrent_jobs, limits.max_enqueued_tokens
    if not 1 <= slots <= block_size:
        raise ValueError("a round needs a slot, and a block as many shards as a round has slots")
    tokens = F.greatest(F.coalesce("est_tokens", F.lit(0)).cast("long"), F.lit(0)).alias("est_tokens")
    waiting = pending_shards(batches).select(F.col("shard_id").cast("long").alias("shard_id"), tokens)
    fitting = waiting.where(F.col("shard_id").isNotNull() & (F.col("est_tokens") <= budget))
    placed = global_index(fitting, ["shard_id"], "place")
    block = F.floor(F.col("place") / F.lit(block_size)).cast("long")
    # The first shards of a block are also shown to the block before.
    shown = F.when(
        (F.col("place") % block_size < slots - 1) & (F.col("place") >= block_size), F.array(block, block - 1)
    ).otherwise(F.array(block))
    blocks = materialize(placed.withColumn("block", F.explode(shown)), "blocks")
    exits = blocks.groupBy("block").applyInArrow(
        lambda table: _exits(table, slots, budget, block_size), "block long, entry int, rounds long, beyond int")
    schema = pa.schema([("block", pa.int64()), ("entry", pa.int32()), ("number", pa.int64())])
    entered = exits.repartition(1).sortWithinPartitions("block", "entry").mapInArrow(
        functools.partial(_followed, schema=schema), "block long, entry int, number long")
    return blocks.join(materialize(entered, "entered"), "block").groupBy("block").applyInArrow(
        lambda table: _numbered(table, slots, budget, block_size), "shard_id long, est_tokens long, round long")
