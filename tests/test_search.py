import functools

import numpy as np
import pytest

from quillon.operators import search as se
from quillon.operators import verify as vf
from quillon.operators.embed import embed_texts, hashed_words
from quillon.operators.points import with_sketch

DIM = 20


def frame(spark, matrix, name="record_id", offset=0):
    rows = [(i + offset, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} bigint, vector array<float>")


def brute(corpus, queries, k):
    def unit(m):
        m = np.asarray(m, np.float32).astype(float)
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    scores = np.round(unit(queries) @ unit(corpus).T, 9)
    found = []
    for q, row in enumerate(scores):
        order = sorted(range(len(row)), key=lambda i: (-row[i], i))[:k]
        found += [(q, i, rank + 1) for rank, i in enumerate(order)]
    return sorted(found)


def hits(df):
    return sorted((r.query_id, r.id, r["rank"]) for r in df.collect())


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(6, DIM))
    clustered = centers[rng.integers(0, 6, 300)] + rng.normal(scale=0.15, size=(300, DIM))
    # A third of all vectors are the same one, and some are zero.
    corpus = np.vstack([clustered, np.repeat(centers[:1], 150, axis=0), np.zeros((3, DIM))])
    queries = np.vstack([centers, rng.normal(size=(4, DIM)), np.zeros((1, DIM))])
    return corpus, queries


@pytest.mark.parametrize("k", [1, 5, 600])
def test_exact_search(spark, data, k):
    corpus, queries = data
    found = se.cosine_top_k(frame(spark, corpus).repartition(5), frame(spark, queries, "query_id"), dim=DIM, k=k)
    assert hits(found) == brute(corpus, queries, k)


def test_blocks_take_over_above_the_bound(spark, data):
    corpus, queries = data
    q = frame(spark, queries, "query_id")
    assert se.small_queries(q, "query_id", "vector", DIM, max_bytes=8 * DIM * 3) is None
    found = se.cosine_top_k(frame(spark, corpus), q, dim=DIM, k=4, max_bytes=8 * DIM * 3)
    assert hits(found) == brute(corpus, queries, 4)
    many = se.blocked_top_k(frame(spark, corpus), q, dim=DIM, k=4, block_queries=4)
    assert hits(many) == brute(corpus, queries, 4)


def test_wide_sketch(spark):
    rng = np.random.default_rng(2)
    corpus, queries = rng.normal(size=(90, 130)), rng.normal(size=(3, 130))
    found = se.hamming_top_k(
        with_sketch(frame(spark, corpus), 130),
        se.small_queries(frame(spark, queries, "query_id"), "query_id", "vector", 130), dim=130, k=7)
    signs = np.asarray(corpus, np.float32) > 0
    expected = []
    for q, row in enumerate(np.asarray(queries, np.float32) > 0):
        distance = (signs != row).sum(axis=1)
        order = sorted(range(90), key=lambda i: (distance[i], i))[:7]
        expected += [(q, i, int(distance[i]), n + 1) for n, i in enumerate(order)]
    listed = lambda df: sorted((r.query_id, r.id, r.distance, r["rank"]) for r in df.collect())
    assert listed(found) == sorted(expected)
    blocks = se.blocked_hamming_top_k(
        with_sketch(frame(spark, corpus), 130), frame(spark, queries, "query_id"), dim=130, k=7, block_queries=1)
    assert listed(blocks) == sorted(expected)


def test_empty_filter_and_string_ids(spark, data):
    corpus, queries = data
    named = frame(spark, corpus).selectExpr("concat('r', record_id) AS record_id", "vector")
    q = frame(spark, queries[:2], "query_id").selectExpr("concat('q', query_id) AS query_id", "vector")
    assert se.cosine_top_k(named.where("false"), q, dim=DIM).count() == 0
    top = se.cosine_top_k(named, q, dim=DIM, k=1).orderBy("query_id").collect()
    assert [r.query_id for r in top] == ["q0", "q1"] and top[0].id == "r300"


def test_other_dimensions_are_left_out(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, None)], "record_id bigint, vector array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, vector array<float>")
    assert hits(se.cosine_top_k(df, q, dim=2)) == [(1, 1, 1)]


def test_search_sends_no_vectors(spark, data):
    corpus, queries = data
    found = se.cosine_top_k(frame(spark, corpus), frame(spark, queries, "query_id"), dim=DIM)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("Exchange") == 1 and "WindowGroupLimit" in plan


def test_embedding(spark):
    docs = spark.createDataFrame([("a", "One two one"), ("b", ""), ("c", None), ("d", "two ONE one\n")], "record_id string, text string")
    vectors = {r.record_id: np.array(r.vector) for r in embed_texts(docs, functools.partial(hashed_words, 8), 8).collect()}
    assert np.linalg.norm(vectors["a"]) == pytest.approx(1.0, abs=1e-6)
    assert np.array_equal(vectors["a"], vectors["d"])
    assert not vectors["b"].any() and not vectors["c"].any()


def test_whole_text_counts(spark):
    text = " ".join(["a"] * 50_000 + ["end"])
    docs = spark.createDataFrame([("x", text), ("y", text[:-4])], "record_id string, text string")
    vectors = [r.vector for r in embed_texts(docs, functools.partial(hashed_words, 64), 64).collect()]
    assert vectors[0] != vectors[1]


def test_audits(spark, data):
    corpus, _ = data
    state = spark.createDataFrame([(str(i), "ok" if i < 5 else "pending") for i in range(8)], "record_id string, upsert_status string")
    records = spark.createDataFrame([(str(i), f"p{i}") for i in range(8)], "record_id string, point_id string")
    points = records.where("record_id < '5'")
    assert tuple(vf.count_match(state, points).first()) == ("count_match", "PASS", 5, 5)
    assert tuple(vf.count_match(state, points.limit(4)).first()) == ("count_match", "FAIL", 5, 4)
    assert tuple(vf.spot_check(state, records, points).first()) == ("spot_check", "PASS", 5, 5)
    assert tuple(vf.spot_check(state, records, points.where("record_id <> '2'")).first()) == ("spot_check", "WARN", 4, 5)
    unique = frame(spark, corpus[:50])
    assert tuple(vf.self_search_check(unique, DIM).first()) == ("self_search", "PASS", 20, 20)
    assert tuple(vf.self_search_check(unique.limit(3), DIM).first()) == ("self_search", "PASS", 3, 3)
    assert tuple(vf.self_search_check(unique.limit(0), DIM).first()) == ("self_search", "WARN", 0, 0)
    broken = unique.selectExpr("record_id", "if(record_id < 45, slice(vector, 1, 3), vector) AS vector").where("record_id > 29")
    assert tuple(vf.self_search_check(broken, DIM).first()) == ("self_search", "WARN", 5, 20)
    assert tuple(vf.size_check(broken, DIM).first()) == ("vector_size", "FAIL", 5, 20)


@pytest.mark.parametrize("hits, status", [([], "PASS"), ([False], "PASS"), ([False, True, False, False, True], "PASS"),
                                          ([False, False, False, False, True], "WARN")])
def test_recall_threshold(spark, hits, status):
    df = spark.createDataFrame([(h,) for h in hits], "hit boolean")
    row = vf.recall_check(df).first()
    assert (row.status, row.ok, row.n) == (status, sum(hits), len(hits))


def test_recall_counts_blank_queries_as_missed(spark):
    points = frame(spark, np.eye(4))
    sample = points.limit(3).select("record_id")
    asked = points.where("record_id < 2")
    hits_df = vf.recall_hits(sample, points, asked, 4, k=1)
    assert sorted(tuple(r) for r in hits_df.collect()) == [(0, True), (1, True), (2, False)]
