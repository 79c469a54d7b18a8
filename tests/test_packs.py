"""Packed files with an index of byte ranges."""

import os

import pytest
from pyspark.sql import functions as F

from quillon.config import DatasetSpec
from quillon.functions.keys import content_hash
from quillon.operators import images as im
from quillon.operators import shards as sh
from quillon.sources import packs as pk


def entries(spark, rows):
    return spark.createDataFrame(rows, "key string, content binary")


def files(path, part="data"):
    return sorted(os.listdir(f"{path}/{part}"))


def test_round_trip_and_edge_rows(spark, tmp_path):
    path = str(tmp_path / "packs")
    assert pk.pack_index(spark, path).count() == 0
    long = b"x" * (3 * pk.BATCH_BYTES)
    rows = [("a", b"one\n"), ("a", b"two\n"), ("b", b""), (None, b"n"), ("c", None), ("d", long), ("é", b"\xff\x00")]
    pk.write_packed(entries(spark, rows).coalesce(1), path)
    index = pk.pack_index(spark, path)
    got = {r.key: bytes(r.content) for r in pk.read_packed(index, path).collect()}
    assert got == {"a": b"one\ntwo\n", "b": b"", "d": long, "é": b"\xff\x00"}
    lines = pk.read_packed(index.where("key = 'a'"), path, lines=True)
    assert sorted(bytes(r.content) for r in lines.collect()) == [b"one", b"two"]
    pk.write_packed(entries(spark, []), path)
    assert pk.pack_index(spark, path).count() == 4


def test_rows_without_a_place_stay(spark, tmp_path):
    path = str(tmp_path / "packs")
    pk.write_packed(entries(spark, [("a", b"1")]).coalesce(1), path)
    placed = spark.createDataFrame([("a", 1), ("z", 2)], "key string, n int").join(pk.pack_index(spark, path), "key", "left")
    got = {(r.key, r.n, r.content and bytes(r.content)) for r in pk.with_content(placed, path).collect()}
    assert got == {("a", 1, b"1"), ("z", 2, None)}


def test_pack_sizes_and_repeated_keys(spark, tmp_path):
    path = str(tmp_path / "packs")
    rows = [(f"k{i % 10}", bytes([i % 10]) * 100) for i in range(40)]
    pk.write_packed(entries(spark, rows).coalesce(1), path, once=True, pack_bytes=250)
    assert len(files(path)) == 4  # a pack closes after the key that fills it: 3, 3, 3 and 1
    assert pk.pack_index(spark, path).count() == 10
    pk.write_packed(entries(spark, rows), path, once=True)
    places = pk.one_place(pk.pack_index(spark, path))
    assert {(r.key, bytes(r.content)) for r in pk.read_packed(places, path).collect()} == set(rows)


def test_a_failed_write_leaves_nothing_to_read(spark, tmp_path):
    path = str(tmp_path / "packs")
    pk.write_packed(entries(spark, [("a", b"1")]), path)
    before = files(path)
    broken = spark.range(0, 8, 1, 4).select(
        F.col("id").cast("string").alias("key"),
        F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.lit("x")).cast("binary").alias("content"))
    with pytest.raises(Exception):
        pk.write_packed(broken, path)
    assert [r.key for r in pk.pack_index(spark, path).collect()] == ["a"]
    assert set(before) <= set(files(path))


def test_files_do_not_follow_the_shards(spark, tmp_path):
    path = str(tmp_path / "requests")
    lines = spark.range(3000).select(
        F.floor(F.col("id") / 5).cast("long").alias("shard_id"), F.format_string("r%05d", "id").alias("record_id"),
        F.concat(F.lit('{"é": '), F.col("id").cast("string"), F.lit("}")).alias("line"))
    lines = sh.by_shard(lines)
    sh.write_request_shards(lines, path, epoch=3)
    sh.write_request_shards(lines, path, epoch=3)  # a step that crashed behind its write is repeated
    places = sh.request_index(spark, path)
    assert places.count() == 600
    assert len(files(path)) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    one = sh.read_request_shards(places.where("shard_id = 7"), path).collect()
    assert [(r.epoch, r.shard_id, r.value) for r in one] == [(3, 7, f'{{"é": {i}}}') for i in range(35, 40)]
    everything = sh.read_request_shards(places, path)
    assert everything.select("shard_id", "value").exceptAll(lines.select("shard_id", "line")).count() == 0
    assert everything.count() == 3000
    size = sh.request_files(places).where("file_name = 'shard_00007.jsonl'").first()["length"]
    assert size == sum(len(f'{{"é": {i}}}\n'.encode()) for i in range(35, 40))


def test_one_shard_reads_its_bytes_only(spark, tmp_path):
    """The rest of the pack may be anything, even gone."""
    path = str(tmp_path / "packs")
    pk.write_packed(entries(spark, [("a", b"first"), ("b", b"second")]).coalesce(1), path)
    place = pk.pack_index(spark, path).where("key = 'a'")
    with open(f"{path}/data/{files(path)[0]}", "r+b") as pack:
        pack.truncate(5)
    assert bytes(pk.read_packed(place, path).first().content) == b"first"


def test_pictures_cross_no_exchange(spark, tmp_path):
    path = str(tmp_path / "blobs")
    pictures = spark.createDataFrame([(f"r{i:02d}", f"t{i}", bytes([i % 4]) * 50) for i in range(20)],
                                     "record_id string, text string, content binary")
    im.store_blobs(pictures, path)
    sizes = len(files(path))
    im.store_blobs(pictures, path)  # all known: no new pack
    assert len(files(path)) == sizes
    assert {bytes(r.content) for r in im.stored_blobs(spark, path).collect()} == {bytes([i]) * 50 for i in range(4)}
    records = pictures.select("record_id", "text", content_hash(F.col("content")).alias("image_sha")).unionByName(
        spark.createDataFrame([("bare", "no picture", None), ("lost", "", "gone")], "record_id string, text string, image_sha string"))
    records.write.parquet(str(tmp_path / "records"))
    records = spark.read.parquet(str(tmp_path / "records"))
    assignment = records.select("record_id", (F.crc32("record_id") % 3).alias("shard_id"))
    lines = sh.request_lines(records, assignment, DatasetSpec(dataset="d", image_column="i"), dim=8, model="m", blobs=path)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    # The map that reads the pictures stands above every exchange.
    assert plan.index("MapInArrow") < plan.index("Exchange")
    assert "content" not in plan[plan.index("Exchange"):]
    assert {r.record_id for r in lines.collect()} == {f"r{i:02d}" for i in range(20)} | {"bare"}
