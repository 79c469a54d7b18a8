import hashlib
import random
from collections import Counter

import numpy as np

from quillon.llm import bwt, queries

SF = "/root/testdata/sf0.001"


def brute(rows, length=200):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i : i + length] for _, t in data for i in range(len(t) - length + 1))
    out = []
    for d, t in data:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = queries.QUERIES["op10_repeats"](spark, SF).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_planted_passages_and_edge_rows(spark, monkeypatch):
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefé ") for _ in range(n))
    passages = [noise(n) for n in (199, 201, 230, 260, 500, 3000)]
    rows = [(i, noise(rng.randrange(400)) + rng.choice(passages) + noise(rng.randrange(400))) for i in range(60)]
    rows += [(100, "x" * 1000), (101, "xy" * 300), (102, "x" * 199), (103, None), (104, ""), (None, rows[3][1]), (105, passages[3]), (105, passages[3]),
             (106, noise(50) + passages[5] + noise(20) + passages[5][:1500]), (107, noise(60_000))]
    for contexts in (2048, 3):  # the smaller bound splits ranges again and again
        monkeypatch.setattr(bwt, "CONTEXTS", contexts)
        df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS first", "3 AS spans", "4 AS data")
        assert sorted(map(tuple, bwt.without_repeats(df).collect()), key=str) == brute(rows)
    assert bwt.without_repeats(df.limit(0)).count() == 0


def test_merged_order_is_the_sorted_order():
    rng = np.random.default_rng(2)
    windows = rng.integers(0, 3, (500, 6)).astype(np.uint16)
    windows[100:120] = windows[300:320]
    parts = [windows[:200], windows[200:201], windows[201:]]
    built = [bwt.shard_columns(p) for p in parts]
    source, common = bwt.merge_shards([c for c, _ in built])
    at, merged = [0] * 3, []
    for z in source:
        merged.append(tuple(parts[z][built[z][1][at[z]]]))
        at[z] += 1
    assert merged == sorted(map(tuple, windows))
    assert [a == b for a, b in zip(merged, merged[1:])] == list(common[1:] == common[:-1])


def test_repeated_windows_over_shards():
    rng = np.random.default_rng(3)
    windows = rng.integers(0, 2, (300, 9)).astype(np.uint8)
    counts = Counter(map(bytes, windows))
    assert list(bwt.repeated_windows(windows, 64)) == [counts[bytes(w)] > 1 for w in windows]


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(4)
    passage = bytes(rng.integers(97, 105, 700).astype(np.uint8))
    a, b = b"qq" * 31 + passage + b"z" * 400, passage + b"yx" * 90
    of = lambda t: {t[s : s + 200]: int(p) - s for p, f, e, _ in zip(*bwt.anchors(t)) for s in range(f, e + 1)}
    x, y = of(a), of(b)
    assert len(set(x) & set(y)) >= 501 and all(x[w] == y[w] for w in set(x) & set(y))
