import math
import random
import re
from collections import Counter

from quillon.llm import lexical, queries

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(UP) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if t}:
        scored = []
        for d, c in held:
            m = 100 - 75 + 75 * sum(c.values()) * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, rank + 1, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


RNG = random.Random(11)
VOCABULARY = [f"t{i}" for i in range(40)] + ["Été", "ÉTÉ", "straße", "日本"]
DOCS = [(i, " ".join(RNG.choice(VOCABULARY) for _ in range(RNG.randrange(1, 40)))) for i in range(150)] + [
    (500, None), (501, ""), (502, "... !!"), (503, "T1, t1; T1!"), (503, "T1, t1; T1!"), (504, "t1 t1 t1"), (None, "t2 t3"), (None, "t2 t3"),
    (505, "t4 " * 60_000), (506, "t9_t8-t7"), (507, "\x00t5\x7ft6"),
] + [(600 + i, "tie t1 t2") for i in range(25)]
ITEMS = [(1, "t1 t1 T2"), (2, "nothing known"), (3, None), (4, ""), (5, "Été 日本 straße"), (6, "tie"), (6, "tie"), (6, "t3"), (None, "t4 t5"),
         (7, " ".join(VOCABULARY) * 30), (8, "...")]


def frames(spark, docs=DOCS, items=ITEMS):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(5).selectExpr("*", "1 AS n", "2 AS terms", "3 AS rank"),
            spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS place", "2 AS doc_id"))


def test_against_brute_force(spark, rows):
    assert rows(lexical.ranked_search(*frames(spark))) == brute(DOCS, ITEMS)


def test_blocks_small_batches_and_merged_heaps(spark, rows, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 16)
    monkeypatch.setattr(lexical, "FAN_IN", 2)
    assert rows(lexical.ranked_search(*frames(spark), k=3, block_bytes=2500)) == brute(DOCS, ITEMS, 3)


def test_empty_tables(spark):
    docs, items = frames(spark)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("text = ''"), items), (docs, items.where("text IS NULL"))):
        assert lexical.ranked_search(d, i).count() == 0


def test_string_item_ids(spark):
    items = spark.createDataFrame([("x", "t1"), (None, "t2")], "item_id string, text string")
    found = lexical.ranked_search(frames(spark)[0], items, k=1)
    assert sorted(str(r.item_id) for r in found.collect()) == ["None", "x"]


def test_registered_query(spark, rows):
    sf = "/root/testdata/sf0.001"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(i, "text").collect()] for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert rows(queries.QUERIES["op12_lexical"](spark, sf)) == brute(docs, items)
