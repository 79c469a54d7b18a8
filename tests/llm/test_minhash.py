import random

import pyarrow as pa

from quillon.llm import minhash, queries
from quillon.llm.components import components

SF = "/root/testdata/sf0.001"


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    m = min(n, len(words))
    return {tuple(words[i : i + m]) for i in range(len(words) - m + 1)}


def brute(rows, n, percent):
    """rows: (doc_id, text) with distinct ids."""
    sets = {d: shingles(t, n) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in ids)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = queries.QUERIES["op1_minhash"](spark, SF).collect()
    assert sorted(map(tuple, found)) == brute(rows, 2, 80)


def test_chains_families_and_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(4):
        text = [rng.choice(words) for _ in range(90)]
        for _ in range(30):  # drifts, so that ends of the chain are no longer alike
            text = list(text)
            text[rng.randrange(90)] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + i, t) for i, t in enumerate(["", None, "one", "ONE", "two one", "\t \n", "x " * 50_000])]
    rows += [(len(rows), "x " * 9), (len(rows) + 1, rows[3][1].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS rep", "2 AS root", "3 AS kept", "4 AS u")
    assert sorted(map(tuple, minhash.near_duplicates(df, 2, 80).collect())) == brute(rows, 2, 80)


def test_repeated_and_missing_ids_and_no_rows(spark):
    schema = "doc_id long, text string"
    rows = [(7, "a b c d"), (7, "a b c d"), (7, "q r s t"), (9, "q r s t"), (None, "a b c d"), (8, None)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, schema), 2, 80).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, [
        (7, 3, 7, True), (7, 3, 7, True), (7, 3, 7, True), (9, 3, 7, False), (None, 3, None, True), (8, 0, 8, True)]))
    assert minhash.near_duplicates(spark.createDataFrame([], schema), 2, 80).count() == 0


def test_each_text_of_a_repeated_id_is_compared():
    base = [f"w{i}" for i in range(60)]
    near, other = " ".join(base).encode(), " ".join(f"o{i}" for i in range(60)).encode()
    copy = " ".join([*base, "more"]).encode()
    for texts in ([other, near], [near, other]):
        batch = pa.RecordBatch.from_arrays(
            [pa.array([1, 1]), pa.array([2, 2]), pa.array(texts), pa.array([copy, copy])], names=["u", "v", "a", "b"])
        (found,) = minhash._confirmed(iter([batch]), 2, 80)
        assert found.to_pydict() == {"u": [1], "v": [2]}


def test_repeated_ids_in_open_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(4):
        text = [rng.choice(words) for _ in range(90)]
        for _ in range(30):
            text = list(text)
            text[rng.randrange(90)] = rng.choice(words)
            texts.append(" ".join(text))
    # Every third document has a second text under its id.
    rows = list(enumerate(texts)) + [(i, " ".join(f"a{i}x{j}" for j in range(40))) for i in range(0, 120, 3)]
    alone = brute([*enumerate(texts)], 2, 80)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in found} == {(d, c, k) for d, _, c, k in alone}
    assert len(found) == len(rows)


def test_components_of_long_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(300)] + [(5, 5), (900, 900), (None, 3)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert all(found[i] == 0 for i in range(61)) and all(found[200 + i] == 100 for i in range(300))
    assert found[900] == 900 and len(found) == 61 + 301 + 1


def test_estimate_follows_similarity(spark):
    rng = random.Random(1)
    base = [f"v{rng.random()}" for _ in range(900)]
    rows = [(i, " ".join(base[i * 100 : i * 100 + 500])) for i in range(4)]
    signed = minhash.signatures(spark.createDataFrame(rows, "doc_id long, text string"), 1)
    for (a, b) in ((0, 0), (0, 1), (0, 3)):
        x, y = signed.where(f"doc_id = {a}").alias("x"), signed.where(f"doc_id = {b}").alias("y")
        estimate = x.join(y, minhash.F.lit(True)).select(minhash.similarity_estimate("x", "y")).first()[0]
        true = (500 - 100 * b) / (500 + 100 * b)
        assert abs(estimate - true) < 0.2
