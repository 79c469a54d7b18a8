import numpy as np
import pytest

from quillon.operators import multiindex as mi
from quillon.registry import search as registered

from test_search import frame, hits
from test_search import brute as ranked

DIM = 32


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(8, DIM))
    near = centers[rng.integers(0, 8, 400)] + rng.normal(scale=0.05, size=(400, DIM))
    # A third of all vectors are the same one, some are zero, some are alone.
    corpus = np.vstack([near, np.repeat(centers[:1], 250, axis=0), np.zeros((4, DIM)), rng.normal(size=(100, DIM))])
    queries = np.vstack([centers, rng.normal(size=(6, DIM)), np.zeros((1, DIM)), near[:10]])
    return corpus, queries


def found(spark, corpus, queries, **options):
    index = mi.build_index(frame(spark, corpus).repartition(4), DIM)
    return hits(mi.sketch_top_k(index, frame(spark, queries, "query_id"), **options))


@pytest.mark.parametrize("k", [1, 5, 900])
def test_exact_mode_is_the_exact_search(spark, data, k):
    assert found(spark, *data, k=k, recall=None) == ranked(*data, k)


def test_many_candidates_small_blocks_and_folders(spark, data, monkeypatch):
    monkeypatch.setattr(mi, "MAX_CANDIDATES", 20)
    monkeypatch.setattr(mi, "FOLDER_ROWS", 10)
    monkeypatch.setattr(mi, "BROADCAST_PAIRS", 3)
    assert found(spark, *data, k=4, recall=None, block_queries=6) == ranked(*data, 4)


def test_recall_at_the_default(spark, data):
    expected = {h[:2] for h in ranked(*data, 5)}
    assert len({h[:2] for h in found(spark, *data, k=5)} & expected) >= 0.9 * len(expected)


def test_registered_recall_on_the_given_vectors(spark):
    """All vec_id % 50 = 0 against the exact search, at the default of 0.95."""
    sf = "/root/testdata/sf0.1"
    exact = {(r.query_id, r.id) for r in registered.cosine_topk(spark, sf).collect()}
    got = {(r.query_id, r.id) for r in registered.sketch_topk(spark, sf).collect()}
    assert len(exact) == 200 and len(got & exact) >= 0.9 * len(exact)


def test_close_neighbours_are_found_in_the_index_alone(spark, data, monkeypatch):
    """Where the best are very near, no query is left to the scan."""
    def refuse(*_, **__):
        raise AssertionError("scanned")

    monkeypatch.setattr(mi, "_scan", refuse)
    corpus, queries = data
    assert len(found(spark, corpus, corpus[400:401], k=3)) == 3


def test_radii():
    assert mi.radius_within(1.0, 64, 0.95) == 0 and mi.radius_within(-1.0, 64, 0.95) == 64
    assert mi.radius_within(0.9, 64, 0.95) < mi.radius_within(0.5, 64, 0.95) < 64
    rng = np.random.default_rng(4)
    units = rng.normal(size=(300, 16))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    turned = units @ mi.rotation(16, 16)
    for q in range(20):
        distance, scores = ((turned > 0) != (turned[q] > 0)).sum(axis=1), units @ units[q]
        for score in (0.2, 0.5, 0.8):
            assert not (scores[distance > mi.radius_beyond(score, turned[q])] >= score).any()
    # The stated share of equally similar vectors lies within the radius.
    turn, other = mi.rotation(256, 256), rng.normal(size=(400, 2, 256))
    inside = 0
    for a, b in other:
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        c = 0.6 * a + 0.8 * b / np.linalg.norm(b)
        inside += ((a @ turn > 0) != (c @ turn > 0)).sum() <= mi.radius_within(0.6, 256, 0.95)
    assert inside >= 0.93 * 400


def test_nulls_sizes_and_empty_tables(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0]), (3, None), (None, [1.0, 0.0]), (4, [0.0, 1.0]), (4, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "record_id bigint, vector array<float>").selectExpr("*", "1 AS id", "2 AS keys")
    asked = df.selectExpr("record_id AS query_id", "vector", "3 AS query")
    index = mi.build_index(df, 2)
    got = hits(mi.sketch_top_k(index, asked, k=1, recall=None))
    assert got == [(1, 1, 1), (4, 4, 1)]
    assert mi.sketch_top_k(index, asked.limit(0)).count() == 0
    assert mi.sketch_top_k(mi.build_index(df.limit(0), 2), asked).count() == 0
