"""Lines in byte ranges against whole files, and streams over files that grow."""

import pytest
from pyspark.sql import functions as F

from quillon.operators.results import parse_result_lines
from quillon.sources import lines as ln
from quillon.sources.packs import filesystem
from quillon.sources.results import attach_batches

FILES = {
    "a.jsonl": b"one\n\n  two\nthree\r\nfour",
    "jobs/b%.jsonl/part-0": "é\nüü\n\n\n".encode() + b"\xff\n" + b"y" * 900 + b"\nlast\n",
    "long.jsonl": b"x" * 5000,
    "newlines.jsonl": b"\n" * 40,
    "empty.jsonl": b"",
    "_hidden": b"no\n",
    "_temporary/x.jsonl": b"no\n",
    ".sub/y.jsonl": b"no\n",
}


def whole(data):
    """(offset, text) of each line."""
    found, at = [], 0
    for line in data.split(b"\n")[:-1 if data.endswith(b"\n") or not data else None]:
        found.append((at, line.removesuffix(b"\r").decode("utf-8", "replace")))
        at += len(line) + 1
    return found


@pytest.fixture
def folder(tmp_path):
    for name, data in FILES.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    return tmp_path


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100, 10_000])
@pytest.mark.parametrize("chunk", [1, 5, 1 << 20])
def test_every_line_lies_in_one_range(folder, monkeypatch, size, chunk):
    monkeypatch.setattr(ln, "READ_BYTES", chunk)
    monkeypatch.setattr(ln, "BATCH_ROWS", 2)
    files, _ = filesystem(str(folder))
    for name, data in FILES.items():
        data = data[:300]
        (folder / "one").write_bytes(data)
        parts = ln.cut(f"{folder}/one", 0, len(data), size)
        rows = [r for p in parts for batch in ln.range_lines(files, p) for r in batch.to_pylist()]
        assert [(r["offset"], r["value"]) for r in rows] == whole(data)
        assert all(r["file_block"] <= r["offset"] < r["file_block"] + size for r in rows)


def test_line_numbers(spark, folder):
    found = ln.with_line_numbers(ln.read_lines(spark, str(folder), range_bytes=64)).collect()
    for name, data in FILES.items():
        rows = sorted((r.number, r.offset, r.value) for r in found if r.file_path.endswith(name.replace("%", "%25")))
        shown = not any(p[0] in "_." for p in name.split("/"))
        assert rows == ([(i, *line) for i, line in enumerate(whole(data))] if shown else [])
    assert {r.file_name for r in found} == {"a.jsonl", "b%.jsonl", "long.jsonl", "newlines.jsonl"}
    assert ln.read_lines(spark, f"{folder}/none").count() == 0


def test_lines_serve_collection(spark, folder):
    batches = spark.createDataFrame([("jobs/a",), ("a",)], "batch_id string")
    met = attach_batches(ln.read_lines(spark, str(folder), range_bytes=8), batches)
    parsed = parse_result_lines(met.where(F.trim("value") != ""), 4)
    assert {(r.batch_id, r.error_class, r["n"]) for r in parsed.groupBy("batch_id", "error_class").agg(F.count(F.lit(1)).alias("n")).collect()} == {("a", "bad_json", 4)}


def stream(spark, folder, out, checkpoint):
    """All that is there, then stop."""
    query = ln.stream_lines(spark, str(folder), range_bytes=16).writeStream.format("parquet").option("path", str(out)).option(
        "checkpointLocation", str(checkpoint)).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.schema(ln.SCHEMA).parquet(str(out))
    return sorted((r.file_path.split("/")[-1], r.offset, r.value) for r in rows.collect())


def test_stream_holds_unfinished_lines_back(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    source.mkdir()
    (source / "a.jsonl").write_bytes(b"first\nsecond line of the file\nthi")
    (source / "b.jsonl").write_bytes(b"unfinished")
    first = [("a.jsonl", 0, "first"), ("a.jsonl", 6, "second line of the file")]
    assert stream(spark, source, out, checkpoint) == first
    assert stream(spark, source, out, checkpoint) == first  # a restart repeats nothing
    with (source / "a.jsonl").open("ab") as more:
        more.write(b"rd\n\nfou")
    (source / "c.jsonl").write_bytes(b"new\n")
    second = sorted([*first, ("a.jsonl", 30, "third"), ("a.jsonl", 36, ""), ("c.jsonl", 0, "new")])
    assert stream(spark, source, out, checkpoint) == second
    with (source / "b.jsonl").open("ab") as more:
        more.write(b" no more\n")
    assert stream(spark, source, out, checkpoint) == sorted([*second, ("b.jsonl", 0, "unfinished no more")])
