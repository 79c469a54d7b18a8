import math
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import language, lines, quality, queries

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = queries.QUERIES["op9_quality"](spark, SF).collect()
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in found)
    held = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in held) / len(held) >= 0.97
    again = queries.QUERIES["op9_quality"](spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_quality_edge_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None), (2, ""), (2, "B " * 60_000)], "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS score", "3 AS learner")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.quality(docs, none).collect()} == {0.5}
    odd = spark.createDataFrame([(1, None), (None, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    assert quality.quality(docs, odd).count() == 4 and quality.quality(docs.limit(0), odd).count() == 0


def test_ftrl_separates_and_shrinks():
    model = quality.Ftrl()
    for _ in range(50):
        for text, label in ((b"good fine words", 1), (b"BAD!! WORDS!!", 0)):
            model.learn(*quality.features(text), label)
    w = model.weights(slice(None))
    score = lambda t: (lambda b, v: v @ w[b] + w[-1])(*quality.features(t))
    assert score(b"good fine words") > 1 > -1 > score(b"BAD!! WORDS!!")
    assert np.count_nonzero(w) < 100


def plain_ftrl(rows, epochs=5, alpha=4.0, beta=1.0, l1=0.005, l2=0.05):
    """Scorer from follow-the-regularised-leader updates, written out one coordinate at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    def score(x):
        return 1 / (1 + math.exp(-max(-35, min(35, sum(weight(i) * v for i, v in x.items())))))

    for _ in range(epochs):
        for x, label in rows:
            p, old = score(x), {i: weight(i) for i in x}
            for i, v in x.items():
                g, before = (p - label) * v, n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / alpha * old[i]
    return score


def test_quality_query_against_plain_updates(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("place", F.xxhash64("doc_id", F.lit("place"))).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    sparse = lambda t: {**dict(zip(*(a.tolist() for a in quality.features((t or "").encode())))), "bias": 1.0}
    train = sorted((r for r in docs if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 5), key=lambda r: r.place)
    score = plain_ftrl([(sparse(r.text), labels[r.doc_id]) for r in train])
    found = {r.doc_id: r.score for r in queries.QUERIES["op9_quality"](spark, sf).collect()}
    assert len(train) > 40 and all(abs(found[r.doc_id] - score(sparse(r.text))) < 1e-4 for r in docs)


def test_repeated_ids_train_once(spark, monkeypatch):
    """Half of all rows under one id, with labels repeated as well, change no weight."""
    monkeypatch.setattr(quality, "LEARNER_ROWS", 10)
    rows = [(i, f"{'good fine' if i % 2 else 'BAD!! $$'} words {i}") for i in range(30)]
    labels = [(i, i % 2) for i in range(30)]
    frame = lambda r, l: (spark.createDataFrame(r, "doc_id long, text string"), spark.createDataFrame(l, "doc_id long, quality int"))
    once = quality.fit(*frame(rows, labels))
    often = quality.fit(*frame(rows + [rows[3]] * 40 + [(3, "zz later text")] * 5, labels + [labels[3]] * 40))
    assert np.count_nonzero(once) and np.array_equal(once, often)


def test_skipped_elements_in_one_pass():
    slow = re.compile(r"(?is)<(script|style|nav|noscript|template)\b.*?</\1\s*>|<!--.*?-->")
    import random

    rng = random.Random(8)
    parts = ["<script>", "</script >", "<SCRIPT x>", "</nav>", "<nav", "<!--", "-->", "<!-->", "a", " ", "\n", "<b>", "</style>", "<styles>", "<style>", "<template/>", "</template"]
    for _ in range(3000):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        assert language._without_skipped(page) == slow.sub(" ", page), page
    start = time.perf_counter()
    for unit in ("<script>", "<nav ", "<!-- ", "<script></nav>", "<", "&amp", "</script "):
        language.visible(unit * (2_000_000 // len(unit)))
    assert time.perf_counter() - start < 60


def test_language_follows_all_evidence(spark):
    texts = {"en": "the house and the garden of the old king ", "de": "das haus und der garten des alten kaisers "}
    docs = spark.createDataFrame([(i, t * 5, lang) for i, (lang, t) in enumerate(texts.items())] + [(9, None, "en"), (8, "x", None)], "doc_id long, text string, lang string")
    page = lambda lang, body: f'<html lang="{lang}"><script>der das und</script><p>{body}</p></html>'
    rows = [(i, f"http://h{i % 2}.example.{'de' if i % 2 else 'com'}/x", page(("en", "de")[i % 2], texts[("en", "de")[i % 2]])) for i in range(40)]
    rows += [(100, "http://h1.example.de/y", ""), (101, "http://h0.example.com/y", None), (102, None, texts["de"]), (None, "no url", page("de", "")),
             (103, "http://new.example.de/", "<p>qqq zzz</p>"), (104, "http://h0.example.com", page("de", texts["de"] * 2000))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS vote", "3 AS votes")
    found = {r.page_id: r for r in language.identify(pages, docs).collect()}
    assert len(found) == len(rows)
    assert all(found[i].lang == ("en", "de")[i % 2] for i in range(40))
    assert [found[i].lang for i in (100, 101, 102, None, 103, 104)] == ["de", "en", "de", "de", "de", "de"]
    assert language.identify(pages.limit(0), docs).count() == 0
    assert {r.lang for r in language.identify(pages, docs.limit(0)).collect()} == {None}


def test_language_query_against_a_single_process(spark):
    langs, model = language.train(spark.read.parquet(f"{SF}/documents.parquet"))
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    host = lambda u: u.split("://")[1].split("/")[0].split(":")[0].split("?")[0].split("#")[0].lower()
    rows, host_votes, suffix_votes = [], {}, {}
    for p in pages:
        b = language.buckets(language.visible(p.html))
        total = model[:, b].sum(axis=1)
        vote = int(total.argmax()) if len(b) else None
        h, d = host(p.url), p.html.split('lang="')[1].split('"')[0] if 'lang="' in p.html else ""
        rows.append((p.page_id, total * min(1, language.TEXT_WORDS / max(1, len(b))), vote, h, ".".join(h.split(".")[-2:]), d))
        if vote is not None:
            for table, key in ((host_votes, h), (suffix_votes, rows[-1][4])):
                table.setdefault(key, np.zeros(len(langs)))[vote] += 1
    told = np.array([[sum(1 for r in rows if r[2] == i and r[5] == m) for m in langs] for i in range(len(langs))])
    others = np.array([sum(1 for r in rows if r[2] == i) for i in range(len(langs))])
    top = (others + 1) / (others.sum() + len(langs))
    expected = {}
    for page, likely, vote, h, s, d in rows:
        own = np.eye(len(langs))[vote]
        sv, hv = suffix_votes[s] - own, host_votes[h] - own
        prior = (sv + 50 * top) / (sv.sum() + 50)
        prior = (hv + 10 * prior) / (hv.sum() + 10)
        e = likely + np.log(prior) + np.log((told[:, langs.index(d)] + 1) / (others + len(langs) + 1))
        expected[page] = (langs[int(e.argmax())], 1 / np.exp(e - e.max()).sum())
    found = queries.QUERIES["op4_language"](spark, SF).collect()
    assert all(r.lang == expected[r.page_id][0] and abs(r.confidence - expected[r.page_id][1]) < 1e-5 for r in found)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("least", [1, 16])
def test_lines_against_brute_force(spark, least):
    base = "the quick brown fox jumps"
    texts = [(1, f"{base}\nunique line number one\n\nshort"), (2, f"{base}!\n{base}\nshort"), (0, f"xx\n{base[:7]}{base[8:]}\n\n"), (3, None), (4, ""),
             (5, "\n".join([base[:12] + "Z" + base[13:], "the quick brown fox jump", "é" * 40, "é" * 39, "é" * 38])), (None, "short\nunique line number one"),
             (8, "a\nPage 1 of 9\né\nshirt\nab\ncd"), (9, "Page 2 of 9\nPage 12 of 9\ncb\nx\nshort!!"),
             (6, "y" * 60_000), (7, "y" * 59_999 + "z"), (7, "y" * 59_999 + "z")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS line", "2 AS key", "3 AS h1", "4 AS n_lines", "5 AS _gone", "6 AS _id", "7 AS _key", "8 AS gone", "9 AS row")
    place = lambda d, i: (-1 if d is None else d, i)
    every = [(place(d, i), x) for d, t in texts if t for i, x in enumerate(t.split("\n")) if x]
    near = lambda a, b: a == b or (min(len(a), len(b)) >= least and abs(len(a) - len(b)) < 2 and (lines.within_one(a, b) if len(a) > 100 else edits(a, b) <= 1))
    expected = []
    for d, t in texts:
        split = t.split("\n") if t else []
        keep = [x for i, x in enumerate(split) if not x or not any(p < place(d, i) and near(x, y) for p, y in every)]
        expected.append((d, len(split), len(split) - len(keep), None if t is None else "\n".join(keep)))
    found = [(r.doc_id, r.n_lines, r.n_removed, r.text) for r in lines.without_repeated_lines(docs, least).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert lines.without_repeated_lines(docs.limit(0)).count() == 0


def test_lines_one_edit_apart_share_a_key():
    import random

    rng = random.Random(4)
    for _ in range(400):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(2, 40)))
        i = rng.randrange(len(a) + 1)
        for b in (a[:i] + "x" + a[i + 1:], a[:i] + "a" + a[i:], a[:i] + a[i + 1:]):
            assert all(set(lines.around(a, parts)) & set(lines.around(b, parts)) for parts in (2, 8))


def test_one_edit():
    words = ["", "a", "b", "ab", "ba", "abc", "abd", "acb", "aabb", "abab", "aab"]
    assert all(lines.within_one(a, b) == (edits(a, b) <= 1) for a in words for b in words)
