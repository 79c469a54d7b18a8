import hashlib
import math
from collections import Counter

import corpus_pipeline
from quillon.llm import quality

from . import test_decontaminate, test_minhash

SF = "/root/testdata/sf0.001"


def accepted(rows, weights):
    kept = []
    for r in rows:
        buckets, values = quality.features(None if r.text is None else r.text.encode())
        if 1 / (1 + math.exp(-float(values @ weights[buckets] + weights[-1]))) >= quality.THRESHOLD:
            kept.append(r)
    return kept


def copies(rows, most=3, seed=42):
    """How often each row is taken, by the rule of the mixture, worked out by hand."""
    count = lambda t: len((t or "").encode().split())
    size, order = Counter(), sorted({r.source for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    for r in rows:
        size[r.source] += count(r.text)
    weight, capped = {s: i % 3 + 1.0 for i, s in enumerate(order)}, set()
    while True:
        free = [s for s in order if s not in capped]
        rest = sum(size.values()) - sum(most * size[s] for s in capped)
        level = rest / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if level * weight[s] >= most * size[s]}
        if not more:
            break
        capped |= more
    rate = {s: 0 if not size[s] else most if s in capped else level * weight[s] / size[s] for s in order}
    out = Counter()
    for r in rows:
        inner = hashlib.md5((r.text or "").encode()).hexdigest()
        key = f"{seed}:{'null' if r.doc_id is None else r.doc_id}:{inner}"
        u = int(hashlib.md5(key.encode()).hexdigest()[:12], 16) / (1 << 48)
        whole = math.floor(rate[r.source])
        out[r.doc_id] += whole + (u < rate[r.source] - whole)
    return +out


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    weights = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = accepted(rows, weights)
    assert 0 < len(rows) < docs.count()
    stay = {r[0] for r in test_minhash.brute([(r.doc_id, r.text) for r in rows], 5, 80) if r[3]}
    assert len(stay) < len(rows)
    rows = [r for r in rows if r.doc_id in stay]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r[0] for r in test_decontaminate.brute([(r.doc_id, r.text) for r in rows], items) if not r[5]}
    assert len(clean) < len(rows)
    rows = [r for r in rows if r.doc_id in clean]

    result = corpus_pipeline.run(spark, SF)
    assert result.columns == [*docs.columns, "shard", "slot"]
    found = result.collect()
    assert Counter(r.doc_id for r in found) == copies(rows)
    text = {r.doc_id: r.text for r in rows}
    assert all(r.text == text[r.doc_id] for r in found)
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    shards, of_source = len(slots), Counter(r.source for r in found)
    held = Counter((r.source, r.shard) for r in found)
    assert all(abs(held[s, i] - n / shards) <= 2 for s, n in of_source.items() for i in slots)


COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, shard int, label string, row string, "
           "kept boolean, copies int, key string, learner int, _text string, _id long")
EXTRA = (0, "l", "r", False, 9, "k", 1, "t", 5)


def as_docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, None, *EXTRA) for d, t, s in rows], COLUMNS)


def test_every_stage_takes_edge_rows(spark):
    near = " ".join(f"w{i}" for i in range(90))
    rows = [(1, near, "a"), (1, near, "a"), (2, near + " more", "a"), (None, near, None), (None, None, None), (3, None, "b"),
            (4, "", "b"), (5, "x " * 40_000, "b"), (6, "other words stand here", "a"), (6, "quite another text of this id", "a")]
    docs = as_docs(spark, rows)
    for at in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, at, SF)
            count = len(out.collect())
            assert count if at is docs else not count, name
            if name != "shards":
                assert out.columns == docs.columns, name
            else:
                assert sorted(out.columns) == sorted({*docs.columns, "shard", "slot"})


def test_near_dedup_keeps_one_row_of_each_group(spark):
    near = " ".join(f"w{i}" for i in range(90))
    rows = [(7, near, "a"), (7, near, "a"), (9, near + " more", "a"), (None, near, None), (None, near, None),
            (3, "alone with other words", "a"), (4, "", "b"), (4, "", "b"), (5, None, "b"), (8, "one text", "b"), (8, "two texts", "b")]
    kept = corpus_pipeline.near_dedup(spark, as_docs(spark, rows), SF).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == {
        (7, near): 1, (3, "alone with other words"): 1, (4, ""): 2, (5, None): 1, (8, "one text"): 1, (8, "two texts"): 1}


def test_near_dedup_tells_texts_of_one_id_apart(spark):
    """Clean texts under a shared id stay; a near copy goes without the other texts of its id."""
    texts = [" ".join(f"t{i}w{j}" for j in range(60)) for i in range(6)]
    rows = [(8, texts[0], "a"), (8, texts[1], "a"), (2, texts[0], "a"), (8, texts[2] + " x", "a"), (None, texts[2], "a"), (None, texts[3], "a"),
            (None, texts[3] + " y", "a"), (None, texts[4], "a"), (None, texts[4], "a"), (8, texts[5], "a")]
    kept = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, as_docs(spark, rows), SF).collect())
    assert kept.pop((None, texts[3]), 0) + kept.pop((None, texts[3] + " y"), 0) == 1
    assert kept == {(2, texts[0]): 1, (8, texts[1]): 1, (8, texts[2] + " x"): 1, (None, texts[4]): 1, (8, texts[5]): 1}
