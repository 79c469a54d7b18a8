"""Merged profiles against exact figures, and unreachable files of planted crashes."""

import math
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillon.config import DatasetSpec, Limits
from quillon.operators import orphans as orp, rollup as ru
from quillon.operators.images import store_blobs
from quillon.plans.workspace import Workspace
from quillon.session import materialize
from quillon.sources.epochs import write_epoch
from quillon.sources.packs import one_place, pack_index, write_packed


@pytest.fixture(scope="module")
def values():
    rng = random.Random(7)
    rows = [(i, rng.choice([None, "a", "b", "c" * 300]), rng.gauss(0, 1) if i % 5 else None, [i % 2], "t" if i % 3 else "hot") for i in range(6000)]
    return rows, "n long, `w.x` string, g double, l array<int>, h string"


def epoch_frames(spark, values):
    rows, ddl = values
    cuts = [0, 100, 100, 3500, 6000]  # one epoch is empty
    return [spark.createDataFrame(rows[a:b], ddl).repartition(3) for a, b in zip(cuts, cuts[1:])]


def test_merged_profile(spark, values, tmp_path):
    rows, _ = values
    store = ru.ProfileStore(spark, str(tmp_path))
    frames = epoch_frames(spark, values)
    for epoch, frame in enumerate(frames):
        store.add(frame, epoch)
    store.add(frames[0], 0)  # again: replaces itself
    found = {r.column: r for r in store.profile(at=[0.1, 0.5, 0.9], top=2).collect()}
    assert [found[c].position for c in ("n", "w.x", "g", "l", "h")] == [0, 1, 2, 3, 4]
    assert [found[c].type for c in ("n", "w.x", "g", "l", "h")] == ["int64", "string", "float64", "sequence<int32>", "string"]
    assert all(r.n_rows == 6000 for r in found.values())
    columns = dict(zip(("n", "w.x", "g", "l", "h"), zip(*rows)))
    for name, column in columns.items():
        held = [str(v) for v in column if v is not None]
        assert found[name].n_nulls == 6000 - len(held)
        assert abs(found[name].approx_distinct - len(set(held))) <= 0.05 * len(set(held))
        numbers = sorted(v for v in column if isinstance(v, (int, float)))
        assert (found[name].quantiles is None) == (not numbers)
        for share, q in zip([0.1, 0.5, 0.9], found[name].quantiles or []):
            below, upto = sum(v < q for v in numbers), sum(v <= q for v in numbers)
            assert below <= (share + ru.RANK_ERROR) * len(numbers) and upto >= (share - ru.RANK_ERROR) * len(numbers)
    assert [tuple(v) for v in found["h"].top] == sorted(Counter(columns["h"]).items(), key=lambda v: (-v[1], v[0]))
    counts = Counter(v for v in columns["w.x"] if v is not None)
    assert sorted(v["count"] for v in found["w.x"].top) == sorted(n for _, n in counts.most_common(2))
    assert [v["item"] for v in found["l"].top] == ['{"value":[0]}', '{"value":[1]}']
    some = {r.column: r.n_rows for r in store.profile([2]).collect()}
    assert set(some.values()) == {3400}


def test_frequent_values_among_many(spark, tmp_path):
    """More distinct values than are tracked: hot ones are still counted closely."""
    store = ru.ProfileStore(spark, str(tmp_path))
    for epoch in range(3):
        store.add(spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit(f"{epoch}-"), "id")).alias("v")), epoch)
    best = store.profile(top=1).first().top[0]
    assert best["item"] == "hot" and abs(best["count"] - 30_000) <= 0.005 * 90_000


def test_profile_reads_sketches_alone(spark, values, tmp_path):
    store = ru.ProfileStore(spark, str(tmp_path))
    for epoch, frame in enumerate(epoch_frames(spark, values)):
        store.add(frame, epoch)
    assert {f.split("/epoch=")[0].removeprefix("file://") for f in store.profile().inputFiles()} == {str(tmp_path)}
    assert ru.ProfileStore(spark, f"{tmp_path}/none").profile().count() == 0


def test_columns_that_come_and_change(spark, tmp_path):
    store = ru.ProfileStore(spark, str(tmp_path))
    store.add(spark.createDataFrame([(1, "x")], "a int, b string"), 1)
    store.add(spark.createDataFrame([("7", math.nan)], "a string, c double"), 2)
    store.add(spark.createDataFrame([], "a string"), 3)
    found = {r.column: (r.position, r.type, r.n_rows, r.n_nulls) for r in store.profile().collect()}
    assert found == {"a": (0, "string", 2, 0), "b": (1, "string", 1, 0), "c": (1, "float64", 1, 0)}


def test_orphan_epochs_and_packs(spark, tmp_path):
    root = str(tmp_path)
    for epoch in (1, 2, 3):
        write_epoch(spark.range(5), f"{root}/records", epoch)
        write_epoch(spark.range(5), f"{root}/points/versions", epoch)
    committed = spark.createDataFrame([(1,), (3,), (3,)], "epoch long")
    files = orp.stored_files(spark, root)
    names = [r.name for r in orp.orphan_epochs(files, committed, 99).orderBy("name").collect()]
    assert names == ["records/epoch=2", "versions/epoch=2"]
    assert orp.orphan_epochs(files, committed, 2).count() == 0
    assert orp.orphan_epochs(files, committed.limit(0), 99).count() == 6
    # A copy in another pack, an unused key, and a pack without any used key.
    blobs = f"{root}/blobs"
    write_packed(spark.createDataFrame([("a", b"xx"), ("b", b"yyy")], "key string, content binary").coalesce(1), blobs)
    write_packed(spark.createDataFrame([("c", b"zzzz")], "key string, content binary"), blobs)
    index, used = pack_index(spark, blobs), spark.createDataFrame([("a",), ("a",), (None,), ("gone",)], "key string")
    places = one_place(index)
    live = places.join(used, "key", "left_semi").select("pack")
    files, now = orp.stored_files(spark, root), int(time.time() * 1000) + 60_000
    assert [r.bytes for r in orp.orphan_packs(files, live, now).collect()] == [4]
    assert orp.orphan_packs(files, live, 0).count() == 0
    assert [(r.name, r.bytes) for r in orp.orphan_entries(index, places, used).collect()] == [("b", 3)]
    assert orp.orphan_entries(index, places, used.limit(0)).count() == 0  # their packs go as a whole
    write_packed(spark.createDataFrame([("a", b"xx"), ("d", b"d")], "key string, content binary").coalesce(1), blobs)
    index, used = pack_index(spark, blobs), used.unionByName(spark.createDataFrame([("d",), ("b",)], "key string"))
    assert [(r.name, r.bytes) for r in orp.orphan_entries(index, one_place(index), used).collect()] == [("a", 2)]


def test_intermediates(spark):
    held = materialize(spark.range(10), "told").inputFiles()[0].split("/")[-2]
    now = int(time.time() * 1000) + 60_000
    assert held in {r.name for r in orp.stale_intermediates(spark, now).collect()}
    assert held not in {r.name for r in orp.stale_intermediates(spark, now - 3_600_000).collect()}


def test_workspace_profile_and_orphans(spark, tmp_path):
    spec = DatasetSpec(dataset="d", id_column="id", text_template="{t}", modality="text")
    ws = Workspace(spark, str(tmp_path), spec, Limits(embedding_dim=4), buckets=2)
    rows = spark.createDataFrame([(str(i), f"text {i % 3}") for i in range(30)], "id string, t string")
    ws.ingest(rows.where("id < 2"), ["id"], profiled=True)
    ws.ingest(rows, ["id"], profiled=True)
    counts = {r.column: (r.n_rows, r.top[0]["count"]) for r in ws.profile().collect()}
    read = 30 + rows.where("id < 2").count()
    assert counts["id"][0] == counts["t"][0] == read
    ws.build_shards()
    later = int(time.time() * 1000) + 3_600_000
    assert ws.orphans(later).count() == 0
    # Steps that died before their commit: an epoch of a table, requests, and blobs.
    crashed = max(ws.commits()) + 5
    write_epoch(rows, f"{tmp_path}/records", crashed)
    write_packed(spark.createDataFrame([(f"{crashed}:9", b"line\n")], "key string, content binary"), f"{tmp_path}/requests")
    store_blobs(spark.createDataFrame([(b"picture",)], "content binary"), f"{tmp_path}/blobs")
    found = {(r.kind, r.name if r.kind == "epoch" else None, r.bytes if r.kind == "pack" else None) for r in ws.orphans(later).collect()}
    assert found == {("epoch", f"records/epoch={crashed}", None), ("pack", None, 5), ("pack", None, 7)}
    assert ws.orphans(min(ws.commits())).count() == 0
    assert ws.records().count() == 30
