import base64
import functools
import hashlib
import json
import struct
import sys
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quillon.config import DatasetSpec, Limits, PayloadSpec
from quillon.operators import fetch as fe
from quillon.operators import images as im
from quillon.operators.cleanup import artifact_files
from quillon.operators.embed import hashed_words
from quillon.operators.shards import request_files
from quillon.plans.workspace import Workspace
from quillon.sources.files import list_files, read_blobs, read_images
from quillon.sources.results import attach_batches, read_result_lines, unknown_lines, write_result_files
from quillon.sources.tables import read_table
from quillon.streaming.collect import collect_stream
from quillon.streaming.ingest import ingest_stream
from quillon.streaming.status import status_stream

DIM = 32
PNG = b"\x89PNG\r\n\x1a\n"
# Test helpers run inside Python workers, which cannot import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def no_wait(seconds):
    return None


def scripted_fetcher():
    """Outcomes named by the URL; ``flaky`` fails twice, and every call is counted."""
    calls = {}

    def fetch(url):
        calls[url] = calls.get(url, 0) + 1
        kind = url.rsplit("/", 1)[-1].split("?")[0]
        if kind.isdigit():
            return fe.Response(int(kind))
        if kind == "timeout":
            return fe.Response(error_kind="timeout")
        if kind == "flaky" and calls[url] < 3:
            return fe.Response(503)
        if kind == "broken":
            return fe.Response(200, error_kind="other")
        if kind == "page":
            return fe.Response(200, content=b"<html>not a picture</html>")
        return fe.Response(200, content=PNG + url.encode())

    return fetch


def test_fetch(spark):
    urls = ["http://x/fine", "http://x/404", "http://x/410", "http://x/400", "http://x/timeout",
            "http://x/flaky", "http://x/broken", "", "http://x/page"]
    records = spark.createDataFrame(
        [(f"{u}#{i}", u) for u in urls for i in range(3)], "record_id string, image_url string")
    fetched = fe.fetch_urls(records, scripted_fetcher, Limits(), sleep=no_wait)
    assert fetched.count() == len(urls)
    got = {r.record_id: (r.image_status, r.attempts, r.image_sha) for r in fe.fetch_outcomes(records, fetched).collect()}
    assert len(got) == 3 * len(urls)
    sha = hashlib.sha256(PNG + b"http://x/fine").hexdigest()
    assert got["http://x/fine#0"] == got["http://x/fine#2"] == ("ok", 1, sha)
    assert got["http://x/404#1"][:2] == ("failed_404", 1) and got["http://x/410#1"][:2] == ("failed_404", 1)
    assert got["http://x/400#0"][:2] == ("failed_other", 5) and got["http://x/timeout#0"][:2] == ("failed_other", 5)
    assert got["http://x/flaky#0"][:2] == ("ok", 3) and got["http://x/broken#0"][:2] == ("failed_other", 1)
    assert got["#0"][:2] == ("failed_other", 1) and got["http://x/page#0"][:2] == ("failed_other", 1)
    nobody = spark.createDataFrame([("n", None)], "record_id string, image_url string")
    assert [tuple(r) for r in fe.fetch_outcomes(nobody, fetched).collect()] == [("n", "failed_other", None, 0)]
    counts = {r.image_status: r.n for r in fe.outcome_counts(fe.fetch_outcomes(records, fetched)).collect()}
    assert counts == {"ok": 6, "failed_404": 6, "failed_other": 15}


def test_waits_double_up_to_a_bound():
    assert [fe._wait(a) for a in range(1, 7)] == [2, 4, 8, 16, 32, 32]


def test_blob_store_keeps_each_content_once(spark, tmp_path):
    path = str(tmp_path / "blobs")
    hot = spark.createDataFrame([(b"hot",)] * 50 + [(b"x",), (None,)], "content binary")
    im.store_blobs(hot, path)
    im.store_blobs(hot.unionByName(spark.createDataFrame([(b"y",)], "content binary")), path)
    got = sorted(bytes(r.content) for r in im.stored_blobs(spark, path).collect())
    assert got == [b"hot", b"x", b"y"]


def png(pixels):
    """A minimal PNG file of an RGB array."""
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    h, w, _ = pixels.shape
    raw = b"".join(b"\x00" + row.tobytes() for row in pixels)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_image_source_and_shrink(spark, tmp_path):
    rng = np.random.default_rng(3)
    (tmp_path / "big.png").write_bytes(png(rng.integers(0, 256, (40, 100, 3), dtype=np.uint8)))
    (tmp_path / "small.png").write_bytes(png(rng.integers(0, 256, (5, 7, 3), dtype=np.uint8)))
    (tmp_path / "flat.png").write_bytes(png(np.full((64, 64, 3), 77, np.uint8)))
    (tmp_path / "junk.png").write_bytes(b"not an image")
    images = read_images(spark, str(tmp_path)).withColumn("name", F.element_at(F.split("origin", "/"), -1))
    got = {r.name: r for r in im.shrink_images(images, 50, ["name"]).collect()}
    assert (got["big.png"].height, got["big.png"].width, got["big.png"].n_channels) == (20, 50, 3)
    assert (got["small.png"].height, got["small.png"].width) == (5, 7)
    assert set(got["flat.png"].pixels) == {77} and got["flat.png"].height == 50
    assert got["junk.png"].pixels is None and got["junk.png"].sha is None
    listed = {r.file_name: r.length for r in list_files(spark, str(tmp_path)).collect()}
    assert listed["junk.png"] == 12 and len(listed) == 4
    assert {r.sha for r in read_blobs(spark, str(tmp_path)).collect()} == {"big", "small", "flat", "junk"}


@pytest.mark.parametrize("size, expected", [((100, 40), (50, 20)), ((50, 50), (50, 50)), ((7, 5), (7, 5)), ((1000, 3), (50, 1))])
def test_target_size(size, expected):
    assert im.target_size(*size, 50) == expected


def answer(requests, path, fail=()):
    """A stand-in for the embedding job: reads request files, writes result files."""
    embed = hashed_words(DIM)
    by_shard = {}
    for row in requests.collect():
        request = json.loads(row.value)
        parts = request["request"]["content"]["parts"]
        text = " ".join(p.get("text", "image") for p in parts)
        line = {"key": request["key"]}
        if request["key"] in fail:
            line["error"] = {"code": 13}
        else:
            line["response"] = {"embedding": {"values": embed([text])[0].tolist()}}
        by_shard.setdefault(row.shard_id, []).append(json.dumps(line))
    for shard, lines in by_shard.items():
        (path / f"jobs_{shard}.jsonl").write_text("\n".join(lines) + "\n")


def test_text_pipeline(spark, tmp_path):
    spec = DatasetSpec(dataset="d", id_column="id", text_template="{title} {body}", modality="text",
                       payload=PayloadSpec(include=("title",)))
    limits = Limits(embedding_dim=DIM, records_per_shard=10, max_concurrent_jobs=2, max_enqueued_tokens=100_000)
    ws = Workspace(spark, str(tmp_path / "ws"), spec, limits)
    words = "ant bee cat dog elk fox gnu hen".split()
    data = [(f"k{i:02d}", f"title {words[i % 8]} {i}", f"body {words[i // 8 % 8]} {i * i}", i) for i in range(25)]
    df = spark.createDataFrame([*data, ("k00", "later copy", "x", 99), (None, "n", "n", 3)],
                               "id string, title string, body string, n int")
    assert tuple(ws.ingest(df, ["n"]).first()) == (27, 1, 25)
    assert tuple(ws.ingest(df, ["n"]).first()) == (27, 1, 0)
    assert ws.records().where("record_id = 'k00'").first().text.startswith("title ant 0")
    shards = ws.build_shards()
    assert sorted((r.shard_id, r.record_count, r.state) for r in shards.collect()) == [
        (0, 10, "PENDING"), (1, 10, "PENDING"), (2, 5, "PENDING")]
    assert ws.build_shards().count() == 0

    results = tmp_path / "results"
    results.mkdir()
    answer(ws.requests(), results, fail={"k03"})

    for expected in ([0, 1], [2]):
        admitted = ws.admit()
        assert [r.shard_id for r in admitted.orderBy("position").collect()] == expected
        jobs = admitted.select("shard_id", F.concat(F.lit("jobs/"), "shard_id").alias("batch_id"))
        ws.submitted(jobs)
        polls = [(f"jobs/{s}", 1, "JOB_STATE_RUNNING") for s in expected]
        polls += [(f"jobs/{s}", 2, "JOB_STATE_EXPIRED" if s == 1 else "JOB_STATE_SUCCEEDED") for s in expected]
        ws.polled(spark.createDataFrame(polls, "batch_id string, seq bigint, job_state string"))
    # The expired shard's records are free again, with one attempt used.
    again = ws.state().where("embed_attempts = 1")
    assert again.count() == 10 and {r.embed_status for r in again.collect()} == {"pending"}

    assert tuple(ws.collect(str(results)).first())[:2] == (14, 1)
    assert tuple(ws.collect(str(results)).first())[:2] == (0, 0)
    (results / "strange.jsonl").write_text("{}\n\n{}\n")
    assert ws.collect(str(results)).first().unknown == 2
    assert ws.vectors().count() == 14
    assert tuple(ws.upsert().first()) == (14, 0)
    assert tuple(ws.upsert().first()) == (0, 0)

    before = sorted(tuple(r) for r in ws.state().collect())
    ws.compact()
    assert sorted(tuple(r) for r in ws.state().collect()) == before
    metrics, states = ws.status()
    assert {r.metric: r["count"] for r in metrics.collect()} == {
        "total": 25, "image_ok": 0, "image_failed": 0, "embed_ok": 14, "embed_failed": 1, "upserted": 14}
    assert {r.state: r.n for r in states.collect()} == {"SUCCEEDED": 2, "EXPIRED": 1}

    # Second round for the expired shard, then all audits pass.
    assert ws.build_shards().first().shard_id == 3
    ws.submitted(spark.createDataFrame([(3, "jobs/3")], "shard_id bigint, batch_id string"))
    ws.polled(spark.createDataFrame([("jobs/3", 3, "JOB_STATE_SUCCEEDED")], "batch_id string, seq bigint, job_state string"))
    answer(ws.requests(), results)
    assert tuple(ws.collect(str(results)).first())[:2] == (10, 0)
    assert tuple(ws.upsert().first()) == (10, 0)
    report = {r.check: (r.status, r.ok, r.n) for r in ws.verify(functools.partial(hashed_words, DIM)).collect()}
    assert report == {"count_match": ("PASS", 24, 24), "spot_check": ("PASS", 24, 24),
                      "self_search": ("PASS", 20, 20), "cross_modal": ("PASS", 5, 5), "vector_size": ("PASS", 24, 24)}
    shard_files = spark.createDataFrame([(f"shard_{i:05d}.jsonl", 100) for i in range(4)], "file_name string, length bigint")
    result_files = list_files(spark, str(results)).select("file_name", "length")
    none = shard_files.where("false")
    report = {r.artifact: (r.eligible, r.total) for r in ws.reclaimable(shard_files, result_files, none).collect()}
    # Shard 0 holds the failed record; shard 1 lost its members.
    assert report == {"shards": (2, 4), "results": (2, 3), "images": (0, 0)}


def test_uncommitted_steps_are_invisible(spark, tmp_path, monkeypatch):
    spec = DatasetSpec(dataset="d", id_column="id", text_template="{t}", modality="text")
    ws = Workspace(spark, str(tmp_path / "ws"), spec, Limits(records_per_shard=2))
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "id string, t string")
    ws.ingest(df, ["t"])
    assert ws.records().count() == 3

    import quillon.plans.workspace as module
    real, written = module.write_epoch, []

    def dies_on_second(rows, path, epoch):
        if written:
            raise RuntimeError("lost")
        written.append(path)
        real(rows, path, epoch)

    monkeypatch.setattr(module, "write_epoch", dies_on_second)
    with pytest.raises(RuntimeError):
        ws.build_shards()
    monkeypatch.setattr(module, "write_epoch", real)
    assert ws.batches().count() == 0 and ws.state().where("embed_status = 'in_batch'").count() == 0
    assert ws.build_shards().count() == 2
    assert sorted(r.shard_id for r in ws.batches().collect()) == [0, 1]
    ws.submitted(spark.createDataFrame([(0, "b0")], "shard_id bigint, batch_id string"))
    ws.cancel(spark.createDataFrame([("b0",)], "batch_id string"))
    freed = ws.state().where("embed_attempts = 1")
    assert freed.count() == 2 and {r.embed_status for r in freed.collect()} == {"pending"}
    assert {r.shard_id: r.state for r in ws.batches().collect()} == {0: "FAILED", 1: "PENDING"}


def test_picture_pipeline(spark, tmp_path):
    spec = DatasetSpec(dataset="d", id_column="id", image_column="url", modality="image")
    ws = Workspace(spark, str(tmp_path / "urls"), spec, Limits(records_per_shard=10))
    df = spark.createDataFrame(
        [("a", "http://x/one"), ("b", "http://x/one"), ("c", "http://x/404"), ("d", None)], "id string, url string")
    ws.ingest(df, ["url"])
    counts = {r.image_status: r.n for r in ws.fetch(scripted_fetcher, no_wait).collect()}
    assert counts == {"ok": 2, "failed_404": 1, "failed_other": 1}
    assert ws.blobs().count() == 1
    assert [r.record_count for r in ws.build_shards().collect()] == [2]
    line = json.loads(ws.requests().first().value)
    assert line["request"]["content"]["parts"][0]["inline_data"] == {
        "mime_type": "image/png", "data": base64.b64encode(PNG + b"http://x/one").decode()}

    binary = DatasetSpec(dataset="d", id_column="id", image_column="pic", modality="multimodal", text_template="{id}")
    ws = Workspace(spark, str(tmp_path / "bytes"), binary)
    df = spark.createDataFrame([("a", bytearray(b"one")), ("b", bytearray(b"one")), ("c", None)], "id string, pic binary")
    ws.ingest(df, ["id"])
    assert ws.blobs().count() == 1
    assert {r.record_id: r.image_status for r in ws.state().collect()} == {"a": "ok", "b": "ok", "c": "pending"}
    assert json.loads(ws.records().first().payload) == {}


def test_decoded_pictures(spark, tmp_path):
    folder = tmp_path / "pngs"
    folder.mkdir()
    (folder / "a.png").write_bytes(png(np.full((64, 32, 3), 9, np.uint8)))
    (folder / "b.png").write_bytes(b"junk")
    raw = spark.read.format("image").load(str(folder))
    df = raw.select(F.regexp_extract("image.origin", r"([^/]+)\.png$", 1).alias("id"), "image")
    spec = DatasetSpec(dataset="d", id_column="id", image_column="image", modality="image")
    ws = Workspace(spark, str(tmp_path / "ws"), spec, Limits(image_max_side=16))
    ws.ingest(df, ["id"])
    assert {r.record_id: r.image_status for r in ws.state().collect()} == {"a": "ok", "b": "failed"}
    stored = [bytes(r.content) for r in ws.blobs().collect()]
    (tmp_path / "back").mkdir()
    (tmp_path / "back" / "x.png").write_bytes(stored[0])
    back = read_images(spark, str(tmp_path / "back")).first()
    assert len(stored) == 1 and (back.height, back.width, set(back.data)) == (16, 8, {9})
    coloured = np.arange(24, dtype=np.uint8).reshape(2, 4, 3)
    (tmp_path / "back" / "x.png").write_bytes(im.png(coloured))
    assert bytes(read_images(spark, str(tmp_path / "back")).first().data) == coloured.tobytes()


# Streams.


def test_collect_stream_resumes(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    batches = spark.createDataFrame([("b/1",), ("b/2",), ("b/3",)], "batch_id string")
    records = spark.createDataFrame([("a",), ("b",)], "record_id string")

    def line(key, x):
        return json.dumps({"key": key, "response": {"embedding": {"values": [x, 1.0 - x]}}}) + "\n"

    def run():
        return collect_stream(spark, str(inbox), str(tmp_path / "out"), str(tmp_path / "offsets"), records, batches, 2, 1)

    (inbox / "b_1.jsonl").write_text(line("a", 1.0) + line("a", 0.0) + "{bad\n\n")
    (inbox / "zz.jsonl").write_text(line("a", 1.0))
    assert [(r.batch_id, r.record_id, r.vector) for r in run().collect()] == [("b/1", "a", [0.0, 1.0])]
    assert run().count() == 1
    batches = batches.unionByName(spark.createDataFrame([("zz",)], "batch_id string"))  # known late
    (inbox / "b_2.jsonl").write_text(line("b", 1.0) + line("ghost", 1.0))
    # The same batch delivered again, in a folder this time.
    (inbox / "b_1.jsonl.d").mkdir()
    assert sorted((r.batch_id, r.record_id, r.known) for r in run().collect()) == [
        ("b/1", "a", True), ("b/2", "b", True), ("b/2", "ghost", False), ("zz", "a", True)]


ODD_IDS = ["batches/1", "é", "jobs:1", "my batch", "a=b", "x%y", "a+b", "%41", "q?#[]{}^'\"*"]


def test_results_of_odd_batch_ids_survive(spark, tmp_path):
    lines = spark.createDataFrame(
        [(b, json.dumps({"key": f"k{i}", "response": {"embedding": {"values": [1.0, 0.0]}}})) for i, b in enumerate(ODD_IDS)],
        "batch_id string, value string")
    write_result_files(lines, str(tmp_path / "out"))
    batches = lines.select("batch_id")
    read = read_result_lines(spark, str(tmp_path / "out"))
    assert sorted(r.batch_id for r in attach_batches(read, batches).collect()) == sorted(ODD_IDS)
    assert unknown_lines(read, batches).count() == 0
    assert sum(r.n for r in unknown_lines(read, batches.where("batch_id <> 'jobs:1'")).collect()) == 1
    records = spark.createDataFrame([("k0",)], "record_id string")
    streamed = collect_stream(spark, str(tmp_path / "out"), str(tmp_path / "v"), str(tmp_path / "c"), records, batches, 2)
    assert sorted(r.batch_id for r in streamed.collect()) == sorted(ODD_IDS)
    files = artifact_files(list_files(spark, str(tmp_path / "out"), "*.txt")).collect()
    assert sorted(r.file_name for r in files) == sorted(b.replace("/", "_") + ".jsonl" for b in ODD_IDS)
    for b in ("batches/1", "é", "my batch", "a=b"):  # names a file of its own may have
        (tmp_path / "plain").mkdir(exist_ok=True)
        (tmp_path / "plain" / (b.replace("/", "_") + ".jsonl")).write_text("{}\n")
    plain = read_result_lines(spark, str(tmp_path / "plain"))
    assert attach_batches(plain, batches).count() == 4


def test_reclaimable_of_written_files(spark, tmp_path):
    spec = DatasetSpec(dataset="d", id_column="id", text_template="{t}", modality="text")
    ws = Workspace(spark, str(tmp_path / "ws"), spec, Limits(embedding_dim=DIM, records_per_shard=3))
    ws.ingest(spark.createDataFrame([(str(i), f"text {i}") for i in range(10)], "id string, t string"), ["id"], limit=7)
    ws.build_shards()
    ws.submitted(ws.admit().selectExpr("shard_id", "concat('jobs:', shard_id, ' x') AS batch_id"))
    results = str(tmp_path / "results")
    ws.polled(ws.embed(functools.partial(hashed_words, DIM), results))
    ws.collect(results)
    ws.upsert()
    listed = [request_files(ws.request_index()), list_files(spark, results, "*.txt")]
    report = {r.artifact: r for r in ws.reclaimable(*listed, listed[0], "shards").collect()}
    for kind, files in zip(("shards", "results"), listed):
        size = files.agg(F.sum("length")).first()[0]
        assert (report[kind].eligible, report[kind].total, report[kind].bytes) == (3, 3, size)


def test_one_split(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "train"))
    spark.range(5).write.parquet(str(tmp_path / "test-00001.parquet"))
    assert read_table(spark, str(tmp_path), split="train").count() == 3
    assert read_table(spark, str(tmp_path), split="test").count() == 5


def test_ingest_stream_keeps_first(spark, tmp_path):
    spec = DatasetSpec(dataset="d", id_column="id", text_template="{t}", modality="text")
    source = str(tmp_path / "in")
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    ddl = "id string, t string"

    def run(values):
        spark.createDataFrame(values, ddl).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ddl).parquet(source)
        return sorted((r.record_id, r.text) for r in ingest_stream(stream, spec, out, offsets).collect())

    assert run([("a", "2"), ("a", "1"), (None, "x")]) == [("a", "1")]
    assert run([("a", "0"), ("b", "5")]) == [("a", "1"), ("b", "5")]


def test_status_stream_keeps_terminal(spark, tmp_path):
    source = str(tmp_path / "in")
    ddl = "batch_id string, seq bigint, job_state string"

    def run(values):
        spark.createDataFrame(values, ddl).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ddl).parquet(source)
        states = status_stream(stream, str(tmp_path / "out"), str(tmp_path / "offsets"))
        return sorted((r.batch_id, r.state) for r in states.collect())

    assert run([("a", 1, "JOB_STATE_PENDING"), ("b", 1, "JOB_STATE_RUNNING")]) == [("a", "SUBMITTED"), ("b", "RUNNING")]
    assert run([("a", 2, "JOB_STATE_SUCCEEDED")]) == [("a", "SUCCEEDED"), ("b", "RUNNING")]
    assert run([("a", 3, "JOB_STATE_RUNNING"), ("b", 2, "JOB_STATE_CANCELLED")]) == [("a", "SUCCEEDED"), ("b", "FAILED")]
