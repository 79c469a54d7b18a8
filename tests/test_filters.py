"""Text and place filters against brute force, and what their scans read."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.operators import geoindex as gi, textindex as ti
from quillon.operators.admitted import admitted_top_k

from test_search import frame

WORDS = ["red", "Blue", "GREEN", "straße", "naïve", "2024", "ring", "bolt"]


def words(text):
    return set(re.findall(r"[^\W_]+", text.lower())) if text else set()


def text_rows(n=400):
    rng = random.Random(3)
    rows = [(i, "the " + " ".join(rng.choices(WORDS, k=rng.randint(1, 5)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "_-,"), (3, "another the text"), (5, rows[5][1]), (None, "the red"), (n + 3, "the " * 20_000)]


FILTERS = [("all", "the"), ("two", "Red, RING"), ("many", "the red blue ring"), ("none", "absent the"), ("empty", " - "), ("null", None), (None, "the"),
           ("split", "straße"), ("split", "naïve"), ("again", "bolt bolt")]


def test_text_matches(spark, monkeypatch):
    data = spark.createDataFrame(text_rows(), "record_id long, text string").selectExpr("*", "1 AS token", "2 AS slice", "3 AS id").repartition(3)
    asked = spark.createDataFrame(FILTERS, "filter_id string, text string").withColumn("need", F.lit(9))
    texts = {}
    for key, text in text_rows():
        texts.setdefault(key, set()).update(words(text))
    needs = {}
    for key, text in FILTERS:
        needs.setdefault(key, set()).update(words(text))
    expected = sorted((f, i) for f, need in needs.items() if f and need for i, held in texts.items() if i is not None and need <= held)
    index = ti.build_text_index(data, slice_ids=50)
    assert index.slices > 1 and index.blocks.agg(F.max(F.size("ids"))).first()[0] < 100
    assert sorted(tuple(r) for r in ti.text_matches(index, asked).collect()) == expected
    monkeypatch.setattr(ti, "PUSHED_TOKENS", 1)
    assert sorted(tuple(r) for r in ti.text_matches(index, asked).collect()) == expected
    monkeypatch.setattr(ti, "FOLDER_POSTINGS", 100)
    index = ti.build_text_index(data)
    assert index.folders > 5
    assert sorted(tuple(r) for r in ti.text_matches(index, asked).collect()) == expected


def test_text_scan_opens_the_asked_blocks_only(spark, monkeypatch):
    monkeypatch.setattr(ti, "FOLDER_POSTINGS", 100)
    data = spark.createDataFrame(text_rows(), "record_id long, text string")
    index = ti.build_text_index(data)
    wanted = spark.createDataFrame([("f", 1, "bolt")], "filter_id string, need long, token string")
    blocks = ti.blocks_of(index, wanted)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(token,bolt)" in plan or "In(token, [bolt])" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*folder", plan)
    assert len(blocks.inputFiles()) >= 1 and {r.token for r in blocks.collect()} == {"bolt"}
    opened = blocks.select(F.input_file_name()).distinct().count()
    assert opened < index.blocks.select(F.input_file_name()).distinct().count()


def test_empty_text_tables(spark):
    none = spark.createDataFrame([], "record_id string, text string")
    asked = spark.createDataFrame([("f", "the")], "filter_id string, text string")
    assert ti.text_matches(ti.build_text_index(none), asked).count() == 0
    some = spark.createDataFrame([("a", "the")], "record_id string, text string")
    assert ti.text_matches(ti.build_text_index(some), asked.limit(0)).count() == 0
    assert [tuple(r) for r in ti.text_matches(ti.build_text_index(some), asked).collect()] == [("f", "a")]


def metres(lon, lat, lon2, lat2):
    a, b, c, d = map(math.radians, (lon, lat, lon2, lat2))
    h = math.sin((d - b) / 2) ** 2 + math.cos(b) * math.cos(d) * math.sin((c - a) / 2) ** 2
    return 2 * gi.EARTH * math.asin(math.sqrt(min(1.0, h)))


def places():
    rng = random.Random(8)
    spread = [(rng.uniform(-180, 180), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(900)]
    # A third lie at one place; others at the poles, the 180th meridian and the borders of cells.
    hot = [(2.35, 48.85)] * 500
    edge = [(180.0, 0.0), (-180.0, 0.0), (0.0, 90.0), (50.0, -90.0), (179.999, 10.0), (-179.999, 10.0), (0.0, 0.0), (90.0, 45.0)]
    rows = [(i, x, y) for i, (x, y) in enumerate(spread + hot + edge)]
    return rows, [(9001, None, 1.0), (9002, 1.0, None), (9003, 181.0, 0.0), (9004, 0.0, float("nan")), (None, 0.0, 0.0)]


@pytest.fixture(scope="module")
def placed(spark):
    rows, off = places()
    data = spark.createDataFrame(rows + off, "record_id long, lon double, lat double").selectExpr("*", "7 AS cell", "8 AS place")
    return rows, gi.build_geo_index(data)


def test_circles(spark, placed):
    rows, index = placed
    rng = random.Random(1)
    circles = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90), 10 ** rng.uniform(2, 7.4)) for i in range(60)]
    circles += [(100, 180.0, 0.0, 5e4), (101, -179.99, 10.0, 5e3), (102, 10.0, 89.9, 3e5), (103, 0.0, -90.0, 1e6), (104, 2.35, 48.85, 0.0), (105, 0.0, 0.0, 3e7)]
    bad = [(200, 0.0, 0.0, -1.0), (201, None, 0.0, 1e6), (202, 0.0, 91.0, 1e6), (203, 0.0, 0.0, float("nan")), (None, 0.0, 0.0, 1e6)]
    asked = spark.createDataFrame(circles + bad + circles[:3], "filter_id long, lon double, lat double, radius double").withColumn("level", F.lit("x"))
    expected = {(f, i) for f, x, y, r in circles for i, lon, lat in rows if metres(x, y, lon, lat) <= r}
    found = gi.geo_circles(index, asked).collect()
    assert len(found) == len(expected) and {(r.filter_id, r.id) for r in found} == expected
    where = {i: (x, y) for i, x, y in rows}
    centre = {f: (x, y) for f, x, y, _ in circles}
    assert all(abs(r.metres - metres(*centre[r.filter_id], *where[r.id])) < 1e-3 for r in found)


def test_boxes(spark, placed):
    rows, index = placed
    boxes = [(1, -10.0, -10.0, 10.0, 10.0), (2, 170.0, -20.0, -170.0, 20.0), (3, -180.0, -90.0, 180.0, 90.0), (4, 0.0, 0.0, 0.0, 0.0), (5, 2.35, 48.85, 90.0, 45.0),
             (6, 2.35, 48.0, 90.0, 48.85), (7, 5.0, 10.0, 6.0, 9.0)]
    bad = [(9, None, 0.0, 1.0, 1.0), (10, 0.0, 0.0, 999.0, 1.0)]
    asked = spark.createDataFrame(boxes + bad, "filter_id long, west double, south double, east double, north double")

    def inside(w, s, e, n, x, y):
        return s <= y <= n and (w <= x <= e if w <= e else x >= w or x <= e)

    expected = sorted((f, i) for f, *box in boxes for i, x, y in rows if inside(*box, x, y))
    assert sorted((r.filter_id, r.id) for r in gi.geo_boxes(index, asked).collect()) == expected


def test_cells_are_those_of_the_cover(spark):
    rows = [(x, y) for _, x, y in places()[0]]
    got = spark.createDataFrame(rows, "lon double, lat double").select(gi.cell_of(F.col("lon"), F.col("lat"))).collect()
    for (x, y), row in zip(rows, got):
        assert row[0] == gi._interleaved(gi._step(x, -180.0, 360.0), gi._step(y, -90.0, 180.0), gi.LEVELS)


def test_cover_and_ranges():
    level, found = gi.squares([(-180.0, -90.0, 180.0, 90.0)])
    assert (level, len(found)) == (3, 64)
    assert gi.squares([(0.0, 0.0, 0.0, 0.0)])[0] == gi.LEVELS
    ranges = [(i * 10, i * 10 + 3) for i in range(400)] + [(8, 9), (5000, 5001)]
    joined = gi.merged_ranges(ranges, 7)
    assert len(joined) == 7 and all(any(a <= low and high <= b for a, b in joined) for low, high in ranges)
    assert gi.merged_ranges([(4, 9), (0, 3), (5, 6)]) == [(0, 9)] and gi.merged_ranges([]) == []


def test_place_scan_skips_files(spark):
    rng = np.random.default_rng(2)
    data = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-80, 80, (3000, 2)))], "record_id long, lon double, lat double")
    index = gi.build_geo_index(data)
    covers = spark.createDataFrame([(0, 6, gi._interleaved(40, 40, 6))], "place long, level int, square long")
    met = gi.covered(index, covers, 1)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(cell", plan)
    opened = index.points.where(F.col("cell").between(gi._interleaved(40, 40, 6) << 20, (gi._interleaved(40, 40, 6) + 1 << 20) - 1))
    files = {r[0] for r in opened.select(F.input_file_name()).distinct().collect()}
    assert len(files) < index.points.select(F.input_file_name()).distinct().count()


def test_many_shapes_need_no_pushed_ranges(spark, placed, monkeypatch):
    rows, index = placed
    asked = spark.createDataFrame([(i, float(i - 100), 10.0, 2e5) for i in range(200)], "filter_id long, lon double, lat double, radius double")
    usual = sorted((r.filter_id, r.id) for r in gi.geo_circles(index, asked).collect())
    monkeypatch.setattr(gi, "MAX_SQUARES", 1000)  # above the bound of collected squares
    assert sorted((r.filter_id, r.id) for r in gi.geo_circles(index, asked).collect()) == usual
    none = asked.limit(0)
    assert gi.geo_circles(index, none).count() == 0 == gi.geo_boxes(index, spark.createDataFrame([], "filter_id long, west double, south double, east double, north double")).count()
    empty = gi.build_geo_index(spark.createDataFrame([], "record_id long, lon double, lat double"))
    assert gi.geo_circles(empty, asked).count() == 0


@pytest.mark.parametrize("block", [4096, 3])
def test_admitted_search(spark, block):
    rng = np.random.default_rng(6)
    corpus, queries = rng.normal(size=(120, 8)), rng.normal(size=(7, 8))
    corpus[:40] = corpus[0]
    pairs = sorted({(int(q), int(i)) for q, i in zip(rng.integers(0, 6, 500), rng.integers(0, 130, 500))})
    asked = spark.createDataFrame(pairs + pairs[:50] + [(0, None), (None, 1), (77, 1)], "query_id long, id long")
    odd = spark.createDataFrame([(3000, [1.0]), (3001, None)], "record_id bigint, vector array<float>")
    found = admitted_top_k(frame(spark, corpus).union(odd).withColumn("id", F.lit(1)), frame(spark, queries, "query_id"), asked, dim=8, k=4, block_queries=block)

    def unit(m):
        m = np.asarray(m, np.float32).astype(float)
        return m / np.linalg.norm(m, axis=1, keepdims=True)

    scores, expected = np.round(unit(queries) @ unit(corpus).T, 9), []
    for q in range(7):
        admitted = sorted((i for a, i in pairs if a == q and i < 120), key=lambda i: (-scores[q, i], i))[:4]
        expected += [(q, i, rank + 1) for rank, i in enumerate(admitted)]
    assert sorted((r.query_id, r.id, r["rank"]) for r in found.collect()) == sorted(expected)
