"""What a step needs on the driver or in one task doesn't grow with the tables."""

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from quillon.config import DatasetSpec, Limits
from quillon.operators import admitted as ad, points as pt, search as se, state as st, textindex as ti
from quillon.operators.admitted import admitted_top_k
from quillon.plans.workspace import Workspace
from quillon.sources import lines as ln
from quillon.sources.packs import _runs, pack_index, read_packed, write_packed
from quillon.streaming import ingest

from test_search import brute, frame, hits


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_upserts_broadcast_no_table(spark):
    state = spark.createDataFrame([("a", "ok", "pending"), ("b", "ok", "ok"), ("c", "ok", "pending")], "record_id string, embed_status string, upsert_status string")
    records = spark.createDataFrame([("a", "pa", "{}"), ("b", "pb", "{}")], "record_id string, point_id string, payload string")
    vectors = spark.createDataFrame([("a", [1.0], 1), ("a", [2.0], 2), ("b", [3.0], 1)], "record_id string, vector array<float>, seq int")
    old = spark.createDataFrame([("pa", "a", [9.0], "{}"), ("pb", "b", [8.0], "{}")], pt.POINT_SCHEMA)
    incoming = pt.points_to_upsert(state, records, vectors, ["seq"])
    snapshot, skipped = pt.upsert_points(old, incoming), pt.upsert_skipped(state, vectors)
    assert sorted((r.record_id, r.vector) for r in snapshot.collect()) == [("a", [2.0]), ("b", [8.0])]
    assert [r.record_id for r in skipped.collect()] == ["c"]
    assert "Broadcast" not in plan(snapshot) and "Broadcast" not in plan(skipped)


def test_short_ranges_share_tasks_and_reads(tmp_path, monkeypatch):
    lines = [f"{i} " + "x" * (i % 40) for i in range(9_000)]
    (tmp_path / "a.txt").write_text("\n".join(lines))
    (tmp_path / "b.txt").write_text("one\n" + "y" * 300_000 + "\nthree")
    reader = ln.LineReader({"path": str(tmp_path), "range_bytes": "100"})
    parts = reader.partitions()
    assert sum(len(p.ranges) for p in parts) > 1000 and len(parts) == 1
    asked, opened = [], fs.LocalFileSystem.open_input_file

    class Counted:
        def __init__(self, source):
            self.source = source

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.source.close()

        def read_at(self, n, at):
            asked.append(n)
            return self.source.read_at(n, at)

    class Files:
        open_input_file = staticmethod(lambda path: Counted(opened(fs.LocalFileSystem(), path)))

    monkeypatch.setattr(ln, "filesystem", lambda folder: (Files, folder))
    monkeypatch.setattr(ln, "TAIL_BYTES", 100)
    found = [r for b in reader.read(parts[0]) for r in b.to_pylist()]
    assert [r["value"] for r in found if r["file_path"].endswith("a.txt")] == lines
    assert [len(r["value"]) for r in found if r["file_path"].endswith("b.txt")] == [3, 300_000, 5]
    assert max(asked) <= 100
    monkeypatch.undo()
    reader.size = 1 << 16
    monkeypatch.setattr(ln, "TASK_BYTES", 1 << 17)
    assert all(1 <= len(p.ranges) <= 4 for p in reader.partitions()) and len(reader.partitions()) > 1


def test_text_filtered_search_makes_no_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    texts = [(i, " ".join(rng.choice(["red", "blue", "ring", "bolt"], 2))) for i in range(90)] + [(90, None), (None, "red")]
    filters = [(i, t) for i, t in texts[:9]] + [(9, " - "), (10, "red absent"), (10, "blue"), (None, "red"), (11, "ring")]
    vectors = rng.normal(size=(80, 8))
    vectors[:30] = vectors[0]
    index = ti.build_text_index(spark.createDataFrame(texts, "record_id long, text string"), slice_ids=20)
    asked = spark.createDataFrame(filters, "filter_id long, text string")
    corpus, queries = frame(spark, vectors), frame(spark, vectors[:11], "query_id")
    pairs = ti.text_matches(index, asked).withColumnRenamed("filter_id", "query_id")
    expected = hits(admitted_top_k(corpus, queries, pairs, dim=8, k=4))
    matches = ti.text_matches(index, asked, paired=False)
    monkeypatch.setattr(ad, "_scored", None)
    for block in (4096, 3):
        assert hits(admitted_top_k(corpus, queries, matches, dim=8, k=4, block_queries=block)) == expected != []
    assert matches.held.count() <= 90 and matches.needed.count() <= 13


def test_a_scan_serves_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    corpus = np.vstack([rng.normal(size=(150, 8)), np.repeat(rng.normal(size=(1, 8)), 60, axis=0)])
    scans, search = [], se._broadcast_top_k
    monkeypatch.setattr(se, "_broadcast_top_k", lambda *a: scans.append(a) or search(*a))
    found = se.blocked_top_k(frame(spark, corpus).repartition(3), frame(spark, corpus, "query_id"), dim=8, k=5, block_queries=20)
    assert hits(found) == brute(corpus, corpus, 5) and len(scans) == 1
    monkeypatch.setattr(se, "SCAN_BYTES", 8 * 8 * 40)
    found = se.blocked_top_k(frame(spark, corpus), frame(spark, corpus, "query_id"), dim=8, k=5, block_queries=20)
    assert hits(found) == brute(corpus, corpus, 5) and len(scans) == 1 + 6


def test_an_epoch_is_sorted_in_small_tasks(spark, tmp_path, monkeypatch):
    lines = spark.createDataFrame([(f"id{i % 70}", i % 140) for i in range(200)], "id string, n int")
    lines.coalesce(1).write.parquet(str(tmp_path / "rows"))
    spec = DatasetSpec(dataset="lines", id_column="id", text_template="n {n}", modality="text")
    seen, first = [], ingest.first_write_wins

    def spied(rows, *keys):
        sizes = [r[0] for r in rows.groupBy(F.spark_partition_id()).count().select("count").collect()]
        seen.append((max(sizes), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
        return first(rows, *keys)

    monkeypatch.setattr(ingest, "TASK_ROWS", 10)
    monkeypatch.setattr(ingest, "first_write_wins", spied)
    stream = spark.readStream.schema(lines.schema).parquet(str(tmp_path / "rows"))
    found = ingest.ingest_stream(stream, spec, str(tmp_path / "records"), str(tmp_path / "offsets"))
    expected = sorted((f"id{i}", min(f"n {i}", f"n {i + 70}")) for i in range(70))
    assert sorted((r.record_id, r.text) for r in found.collect()) == expected
    assert len(seen) == 1 and seen[0][0] <= 20 and seen[0][1] == 20
    assert spark.conf.get("spark.sql.shuffle.partitions") == "3"


def test_a_round_folds_its_own_records(spark, tmp_path, monkeypatch):
    spec = DatasetSpec(dataset="d", id_column="id", text_template="{text}", modality="text")
    ws = Workspace(spark, str(tmp_path / "ws"), spec, Limits(embedding_dim=8, records_per_shard=2, max_concurrent_jobs=1), buckets=2)
    ws.ingest(spark.createDataFrame([(f"r{i}", f"text {i}") for i in range(6)], "id string, text string"), ["id"])
    ws.build_shards()
    jobs = spark.createDataFrame([(1, "jobs/1")], "shard_id long, batch_id string")
    folded, fold = [], st.fold_events
    monkeypatch.setattr(st, "fold_events", lambda events: folded.append({r[0] for r in events.select("record_id").collect()}) or fold(events))
    ws.submitted(jobs)
    assert folded == [{"r2", "r3"}]
    ws.cancel(jobs)
    assert folded[1:] == [{"r2", "r3"}]
    ws.compact()
    state = {r.record_id: (r.embed_status, r.embed_attempts, r.batch_id, r.shard_id) for r in ws.state().collect()}
    assert {k for k, v in state.items() if v == ("pending", 1, None, None)} == {"r2", "r3"}
    only = spark.createDataFrame([("r2",), ("r5",), ("none",)], "record_id string")
    assert {r.record_id: (r.embed_status, r.embed_attempts, r.batch_id, r.shard_id) for r in ws.state(only).collect()} == {k: state[k] for k in ("r2", "r5")}


def small_workspace(spark, tmp_path, records=8):
    spec = DatasetSpec(dataset="d", id_column="id", text_template="{text}", modality="text")
    ws = Workspace(spark, str(tmp_path / "ws"), spec, Limits(embedding_dim=8, records_per_shard=2, max_concurrent_jobs=1), buckets=2)
    ws.ingest(spark.createDataFrame([(f"r{i}", f"text {i}") for i in range(records)], "id string, text string"), ["id"])
    ws.build_shards()
    return ws


def one_round(spark, ws, shard, state="JOB_STATE_SUCCEEDED"):
    assert [r.shard_id for r in ws.admit().collect()] == [shard]
    ws.submitted(spark.createDataFrame([(shard, f"jobs/{shard}")], "shard_id long, batch_id string"))
    ws.polled(spark.createDataFrame([(f"jobs/{shard}", 1, state)], "batch_id string, seq bigint, job_state string"))


def test_a_round_reads_no_epochs_of_the_rounds_before(spark, tmp_path, monkeypatch):
    import quillon.plans.workspace as module

    ws, read, real = small_workspace(spark, tmp_path), [], module.read_epochs

    def spied(spark, path, schema, only=None):
        read.append((path.rsplit("/", 1)[-1], None if only is None else len(only)))
        return real(spark, path, schema, only)

    monkeypatch.setattr(module, "read_epochs", spied)
    rounds = []
    for shard in range(4):
        one_round(spark, ws, shard)
        rounds.append(sorted(read))
        read.clear()
    # Whatever came before: the ingest, the shards' events, and the events of one step at a time.
    assert rounds[1] == rounds[2] == rounds[3] and set(rounds[3]) == {("records", 1), ("record_events", 1), ("batch_events", 1)}
    assert {r.batch_id for r in ws.state().collect()} == {f"jobs/{i}" for i in range(4)}
    assert {(r.shard_id, r.state) for r in ws.batches().collect()} == {(i, "SUCCEEDED") for i in range(4)}


def test_a_poll_without_failures_leaves_the_records_alone(spark, tmp_path):
    ws = small_workspace(spark, tmp_path, records=6)
    one_round(spark, ws, 0)
    settled = max(ws.commits())
    assert not (tmp_path / "ws" / "record_events" / f"epoch={settled}").exists()
    one_round(spark, ws, 1, "JOB_STATE_EXPIRED")
    one_round(spark, ws, 2)
    assert (tmp_path / "ws" / "record_events" / f"epoch={sorted(ws.commits())[-3]}").exists()
    state = {r.record_id: (r.embed_status, r.embed_attempts, r.batch_id, r.shard_id) for r in ws.state().collect()}
    assert {k for k, v in state.items() if v == ("pending", 1, None, None)} == {"r2", "r3"}
    # Freed records come back in a new shard, and a snapshot between changes nothing.
    ws.compact()
    assert [r.shard_id for r in ws.build_shards().collect()] == [3]
    one_round(spark, ws, 3)
    state = {r.record_id: (r.embed_status, r.embed_attempts, r.batch_id, r.shard_id) for r in ws.state().collect()}
    assert {k for k, v in state.items() if v == ("in_batch", 1, "jobs/3", 3)} == {"r2", "r3"}
    again = Workspace(spark, ws.root, ws.spec, ws.limits)
    assert sorted(map(tuple, again.batches().collect())) == sorted(map(tuple, ws.batches().collect()))


def test_batches_see_steps_of_other_sessions(spark, tmp_path, monkeypatch):
    ws = small_workspace(spark, tmp_path, records=4)
    other = Workspace(spark, ws.root, ws.spec, ws.limits)
    early = other._next_epoch()
    ws.submitted(spark.createDataFrame([(0, "jobs/0")], "shard_id long, batch_id string"))
    assert {(r.shard_id, r.state) for r in ws.batches().collect()} == {(0, "SUBMITTED"), (1, "PENDING")}
    # Begun before that step, ended after it.
    monkeypatch.setattr(other, "_next_epoch", lambda: early)
    other.submitted(spark.createDataFrame([(1, "jobs/1")], "shard_id long, batch_id string"))
    ws.refresh()
    assert {(r.shard_id, r.batch_id, r.state) for r in ws.batches().collect()} == {
        (0, "jobs/0", "SUBMITTED"), (1, "jobs/1", "SUBMITTED")}


def test_little_is_read_in_many_tasks(spark, tmp_path):
    entries = spark.createDataFrame([(f"k{i:02d}", b"x" * 1000) for i in range(64)], "key string, content binary")
    write_packed(entries.coalesce(1), str(tmp_path))
    read = read_packed(pack_index(spark, str(tmp_path)), str(tmp_path))
    parts = [r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(parts) == 64 and len(parts) == 3
    assert {(r.key, bytes(r.content)) for r in read.collect()} == {(f"k{i:02d}", b"x" * 1000) for i in range(64)}


def test_a_key_is_packed_in_one_piece():
    batch = pa.RecordBatch.from_pydict(
        {"key": ["skipped", "a", "a", "b", "c", "a"], "content": [b"zz", b"1", b"23", b"", b"4", b"5"]},
        pa.schema([("key", pa.string()), ("content", pa.binary())]))
    found = [(key, content.to_pybytes(), first) for key, content, first in _runs(batch.slice(1))]
    assert found == [("a", b"123", 1), ("b", b"", 0), ("c", b"4", 1), ("a", b"5", 1)]
    assert list(_runs(batch.slice(6))) == []
