import math
import random
import zlib

import pytest
from pyarrow import fs

from quillon.llm import knn, warc

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every, k):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in good:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def test_topk_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(knn, "DATA_BLOCK", 100)
    monkeypatch.setattr(knn, "QUERY_BLOCK", 7)
    rng = random.Random(3)
    centres = [[rng.gauss(0, 2) for _ in range(6)] for _ in range(5)]
    rows = [(i, [float(c + rng.gauss(0, 0.1)) for c in centres[i % 5]]) for i in range(600)]
    rows += [(600 + i, [1.0] * 6) for i in range(90)]  # one vector, many times
    import numpy as np

    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    rows += [(1000, None), (1010, [1.0, None] + [0.0] * 4), (1020, [float("nan")] * 6), (1030, [float("inf")] * 6), (1040, [2.0, 1.0]), (1050, []), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS v", "3 AS cell")
    assert sorted(map(tuple, knn.exact_top_k(df, 10, 7, pivots=8).collect())) == brute(rows, 10, 7)


def test_repeated_query_ids_prune_no_partner(spark):
    # The rows of one query id fill the places nearest to a pivot; its partners score less.
    rng = random.Random(4)
    rows = [(0, [float(8 + i % 2), 8.0]) for i in range(40)]
    rows += [(i, [rng.uniform(-2, 2), rng.uniform(-2, 2)]) for i in range(1, 60)]
    found = sorted(map(tuple, knn.exact_top_k(spark.createDataFrame(rows, SCHEMA), 100, 7, pivots=99).collect()))
    partners = [r for r in rows if r[0]]
    asked = min(v for i, v in rows if i == 0)
    assert found == brute([(0, asked), *partners], 100, 7)


def test_topk_of_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [-1.0, 0.5])]
    assert sorted(map(tuple, knn.exact_top_k(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows, 100, 10)
    assert knn.exact_top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert knn.exact_top_k(spark.createDataFrame(rows[1:], SCHEMA)).count() == 0
    assert knn.exact_top_k(spark.createDataFrame(rows[:1], SCHEMA)).count() == 0


def test_large_components_spoil_no_other_score(spark):
    """Scores that fit are exact beside ones that end at the ends of 64 bits."""
    rng = random.Random(5)
    rows = [(i, [float(rng.randrange(-9, 9)) for _ in range(4)]) for i in range(120)]
    rows += [(200, [2.0**40] * 4), (201, [-(2.0**40)] * 4), (202, [2.0**41, 0.0, 0.0, 1.0]), (300, [2.0**30, -(2.0**30), 0.0, 0.0])]
    got = sorted(map(tuple, knn.exact_top_k(spark.createDataFrame(rows, SCHEMA), 20, 130, pivots=8).collect()))
    low, high = -(1 << 63), (1 << 63) - 1
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    wanted = []
    for q, x in good:
        if q % 20 == 0:
            scores = sorted((-min(max(sum(a * b for a, b in zip(x, y)), low), high), i) for i, y in good if i != q)
            wanted += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert got == sorted(wanted)
    few = sorted(map(tuple, knn.exact_top_k(spark.createDataFrame(rows, SCHEMA), 20, 3, pivots=8).collect()))
    assert few == sorted(r for r in wanted if r[1] <= 3)


PAGES = [(1, "http://a/é b", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (3, None, None), (4, "http://d", ""), (5, "http://e", "x\r\n\r\nWARC/1.1\r\n" * 40_000),
         (None, "http://f", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (None, "http://g", "alone")]


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    folder = f"file://{tmp_path}"
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS place", "2 AS archive", "3 AS size").coalesce(2)
    found = warc.archived(df, folder).collect()
    expected = []
    for page, _, text in PAGES:
        payload = (text or "").encode()
        ids = [p for p, _, t in PAGES if (t or "").encode() == payload and p is not None]
        best = max(ids, default=None)
        again = best is not None and page != best
        expected.append((page, len(payload), warc.payload_digest(payload), "revisit" if again else "response", best if again else None))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    # Every record is a member of its own, and the sidecar tells where.
    for index in tmp_path.glob("*.index"):
        data = index.with_suffix("").read_bytes()
        for line in index.read_text().splitlines():
            page, kind, start, length = line.split()
            headers, block = warc.parse(zlib.decompress(data[int(start) : int(start) + int(length)], 31))
            assert headers["WARC-Type"] == kind and headers["WARC-Record-ID"] == f"<urn:page:{page}>"
    assert list(tmp_path.glob("records-*.gz")) and fs.FileSystem.from_uri(folder)


def test_no_pages_and_smallest_payload(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert warc.archived(df.limit(0), f"file://{tmp_path}/none").count() == 0
    folder = f"file://{tmp_path}/all"
    index = warc.normalise(warc.write_archives(df, folder), folder, smallest=1)
    kinds = {r.page_id: r.record_type for r in warc.read_records(index, folder).collect()}
    assert kinds[3] == kinds[4] == "response" and kinds[1] == "revisit"


def test_broken_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.records(iter([b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab"])))
    with pytest.raises(ValueError):
        list(warc.records(iter([b"no record\r\nContent-Length: 0\r\n\r\n\r\n\r\n"])))
