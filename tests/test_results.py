import json

import pytest
from pyspark.sql import functions as F

from quillon.operators import points as pt
from quillon.operators import results as rs
from quillon.operators import cleanup as cl
from quillon.operators.state import fold_events
from quillon.sources.results import attach_batches, read_result_lines


def vec(x, y):
    return {"response": {"embedding": {"values": [x, y]}}}


LINES = [
    (json.dumps({"key": "a", **vec(1.0, 0.0)}), "a", None),
    (json.dumps({"key": 7, **vec(0.6, 0.8)}), "7", None),
    ("{bad", None, "bad_json"),
    ("[1]", None, "bad_json"),
    ("3", None, "bad_json"),
    (json.dumps({**vec(1.0, 0.0)}), None, "missing_key"),
    (json.dumps({"key": None, **vec(1.0, 0.0)}), None, "missing_key"),
    (json.dumps({"key": "e", "error": {"code": 5}}), "e", "error"),
    (json.dumps({"key": "f", "error": None, **vec(1.0, 0.0)}), "f", "error"),
    (json.dumps({"key": "g", "response": None}), "g", "empty_values"),
    (json.dumps({"key": "h"}), "h", "empty_values"),
    (json.dumps({"key": "i", "response": {"embedding": {"values": []}}}), "i", "empty_values"),
    (json.dumps({"key": "j", "response": {"embedding": {"values": [1.0]}}}), "j", "wrong_dim"),
    (json.dumps({"key": "k", "response": {"embedding": {"values": [1.0, None]}}}), "k", "empty_values"),
    (json.dumps({"key": "l", **vec(0.94, 0.0)}), "l", None),
    (json.dumps({"key": "m", **vec(1.06, 0.0)}), "m", None),
    (json.dumps({"key": "n", **vec(0.95, 0.0)}), "n", None),
    (json.dumps({"key": "", "error": "x"}), "", "error"),
]


def frame(spark, values, batch="b/1"):
    rows = [(v, batch, "f", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value string, batch_id string, file_path string, file_block bigint, line_no bigint")


def test_every_kind_of_line(spark):
    parsed = rs.parse_result_lines(frame(spark, [l for l, _, _ in LINES]), 2).orderBy("line_no").collect()
    for row, (line, key, error) in zip(parsed, LINES):
        assert (row.key, row.error_class) == (key, error), line
        assert (row.vector is None) == (error is not None)
    warned = {r.key for r in parsed if r.norm_warning}
    assert warned == {"l", "m"}


def test_split_and_totals(spark):
    parsed = rs.parse_result_lines(frame(spark, [l for l, _, _ in LINES]), 2)
    assert rs.usable_results(parsed).count() == 5
    assert {r.key for r in rs.failed_results(parsed).collect()} == set("efghijk")
    assert tuple(rs.collect_totals(parsed).first()) == (5, 7, 6, 2)


def test_failure_beats_success_of_one_run(spark):
    lines = [json.dumps({"key": "a", "error": "x"}), json.dumps({"key": "a", **vec(1.0, 0.0)})]
    events = rs.result_events(rs.parse_result_lines(frame(spark, lines), 2), 4)
    row = fold_events(events).first()
    assert (row.embed_status, row.embed_attempts) == ("failed", 1)


def test_collect_once_last_line_wins(spark):
    lines = [json.dumps({"key": "a", **vec(1.0, 0.0)}), json.dumps({"key": "a", **vec(0.0, 1.0)}),
             json.dumps({"key": "ghost", **vec(1.0, 0.0)})]
    parsed = rs.parse_result_lines(frame(spark, lines), 2)
    records = spark.createDataFrame([("a",)], "record_id string")
    first = rs.collect_vectors(parsed, records)
    got = {r.record_id: r for r in first.collect()}
    assert got["a"].vector == [0.0, 1.0] and got["a"].known and len(got["a"].point_id) == 36
    assert got["ghost"].point_id == "" and not got["ghost"].known
    assert rs.collect_vectors(parsed, records, first).count() == 0


def test_result_files_by_name(spark, tmp_path):
    (tmp_path / "b_1.jsonl").write_text("\n  \n" + json.dumps({"key": "a"}) + "\n\n" + json.dumps({"key": "b"}) + "\n")
    (tmp_path / "other.jsonl").write_text(json.dumps({"key": "c"}) + "\n")
    folder = tmp_path / "b_2.jsonl"
    folder.mkdir()
    (folder / "part-0").write_text(json.dumps({"key": "d"}) + "\n")
    batches = spark.createDataFrame([("b/1",), ("b/2",), ("b/3",)], "batch_id string")
    lines = attach_batches(read_result_lines(spark, str(tmp_path)), batches)
    got = sorted((r.batch_id, json.loads(r.value)["key"]) for r in lines.collect())
    assert got == [("b/1", "a"), ("b/1", "b"), ("b/2", "d")]


def test_upsert(spark, rows):
    state = spark.createDataFrame(
        [("a", "ok", "pending"), ("b", "ok", "pending"), ("c", "ok", "ok"), ("d", "pending", "pending")],
        "record_id string, embed_status string, upsert_status string")
    records = spark.createDataFrame([(k, f"p{k}", f'{{"k":"{k}"}}') for k in "abcd"], "record_id string, point_id string, payload string")
    vectors = spark.createDataFrame(
        [("a", [1.0], 1), ("a", [2.0], 2), ("c", [3.0], 1), ("d", [4.0], 1)],
        "record_id string, vector array<float>, seq int")
    incoming = pt.points_to_upsert(state, records, vectors, ["seq"])
    assert rows(incoming) == [("pa", "a", [2.0], '{"k":"a"}')]
    assert [r.record_id for r in pt.upsert_skipped(state, vectors).collect()] == ["b"]
    old = spark.createDataFrame([("pa", "a", [9.0], "{}"), ("px", "x", [8.0], "{}")], incoming.schema)
    assert rows(pt.upsert_points(old, incoming)) == [("pa", "a", [2.0], '{"k":"a"}'), ("px", "x", [8.0], "{}")]


def test_typed_payload(spark):
    payload = json.dumps({
        "i": 5, "f": "1.5", "b": True, "t": "2024-01-02T03:04:05", "u": "6BA7B810-9DAD-11D1-80B4-00C04FD430C8",
        "g": {"lon": 1.0, "lat": 2.0}, "k": "x", "bad": "nope"})
    df = spark.createDataFrame([(payload,), ("{}",)], "payload string")
    kinds = {"i": "integer", "f": "float", "b": "bool", "t": "datetime", "u": "uuid", "g": "geo", "k": "keyword",
             "bad": "integer", "gone": "text"}
    first, second = pt.typed_payload(df, kinds).collect()
    assert (first.i, first.f, first.b, str(first.t)) == (5, 1.5, True, "2024-01-02 03:04:05")
    assert first.u == "6ba7b810-9dad-11d1-80b4-00c04fd430c8" and (first.g.lon, first.g.lat) == (1.0, 2.0)
    assert (first.k, first.bad, first.gone) == ("x", None, None)
    assert second.i is None and second.k is None
    with pytest.raises(ValueError, match="Supported"):
        pt.typed_payload(df, {"i": "number"})


def test_cleanup(spark, rows):
    batches = spark.createDataFrame([
        (1, "b/1", "SUCCEEDED", "s1"), (2, "b/2", "SUCCEEDED", "s2"), (3, "b/3", "SUBMITTED", "s3"),
        (4, "b/4", "SUCCEEDED", "s4"), (5, None, "PENDING", None)],
        "shard_id bigint, batch_id string, state string, request_file string")
    state = spark.createDataFrame([
        ("a", 1, "b/1", "ok", "ok"), ("b", 1, "b/1", "ok", "ok"),
        ("c", 2, "b/2", "ok", "pending"), ("d", 2, "b/2", "failed", "pending"),
        ("e", 3, "b/3", "ok", "ok"), ("f", None, None, "pending", "pending")],
        "record_id string, shard_id bigint, batch_id string, embed_status string, upsert_status string")
    assert rows(cl.eligible_shards(batches, state).select("shard_id")) == [(1,), (3,)]
    assert rows(cl.eligible_results(batches, state).select("result_file")) == [("b_1.jsonl",)]
    files = spark.createDataFrame([("s1", 10), ("b_1.jsonl", 7)], "file_name string, length bigint")
    report = cl.reclaimable(batches, state, files, files, files)
    assert rows(report) == [("images", 2, 2, 0, 17), ("results", 1, 3, 2, 7), ("shards", 1, 4, 3, 10)]
    with pytest.raises(ValueError, match="scope"):
        cl.reclaimable(batches, state, files, files, files, "everything")


def test_deliver_points(spark, tmp_path):
    points = spark.createDataFrame(
        [(f"p{i}", f"r{i}", [float(i)], "{}") for i in range(10)],
        "point_id string, record_id string, vector array<float>, payload string").coalesce(1)
    sizes = str(tmp_path / "sizes")

    def make_writer():
        failures = {"left": 1}

        def write(rows):
            if any(r["point_id"] == "p9" for r in rows):
                raise IOError("always down")
            if failures["left"]:
                failures["left"] -= 1
                raise IOError("down once")
            with open(sizes, "a") as f:
                f.write(f"{len(rows)}\n")

        return write

    sent = pt.deliver_points(points, make_writer, chunk=4)
    assert {r.point_id for r in sent.collect() if not r.delivered} == {"p8", "p9"}
    assert open(sizes).read().split() == ["4", "4"]


def test_typed_layout_prunes_folders(spark, tmp_path):
    points = spark.createDataFrame(
        [("a", '{"brand":"x","n":5}'), ("b", '{"brand":"y","n":"no"}')], "point_id string, payload string")
    path = str(tmp_path / "typed")
    pt.write_typed_points(points, path, {"brand": "keyword", "n": "integer"}, ["brand"])
    kept = spark.read.parquet(path).where("brand = 'x' AND n > 3")
    assert [r.point_id for r in kept.collect()] == ["a"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(brand" in plan and "GreaterThan(n,3)" in plan
