import hashlib
import re

from quillon.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UP))


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in wins[tuple(w[i : i + n])] if x is not None}
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


LONG = " ".join(f"w{i}" for i in range(30))
DOCS = [
    (1, f"intro {LONG} end"), (1, f"intro {LONG} end"), (2, LONG.upper().replace(" ", " -- ")), (3, None), (None, "Short item"),
    (4, ""), (5, "short  ITEM!short item"), (6, "é è ê"), (7, "a " * 30_000), (8, "w1 w2 w3 w4 w5 w6 w7 w8 w9"), (9, "~".join(["w0"] * 40)),
]
ITEMS = [(10, LONG), (9, "short item"), (2, " ".join(f"w{i}" for i in range(5, 16))), (3, None), (4, "..."), (None, "é è ê"), (5, "w0 " * 12)]


def frames(spark, docs=DOCS, items=ITEMS):
    return (spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "'x' AS words", "1 AS items", "2 AS key", "3 AS h", "4 AS _hits", "5 AS _id", "6 AS _key", "7 AS place", "8 AS row", "9 AS hits"),
            spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS run"))


def test_against_brute_force(spark):
    found = decontaminate.contamination(*frames(spark)).collect()
    assert sorted(map(tuple, found), key=str) == brute(DOCS, ITEMS)


def test_blocks_of_windows_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 9)
    found = decontaminate.contamination(*frames(spark)).collect()
    assert sorted(map(tuple, found), key=str) == brute(DOCS, ITEMS)


def test_no_window_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 9)
    plan = decontaminate.matches(*frames(spark))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("BroadcastHashJoin") > 1


def test_very_long_text_with_many_lengths(spark):
    items = [(n, " ".join(f"b{n}x{i}" for i in range(n))) for n in range(1, 11)]
    text = " ".join(f"w{i % 9973}" for i in range(200_000)) + " " + " - ".join(t for _, t in items)
    docs = [(1, text), (2, text[:50])]
    found = decontaminate.contamination(*frames(spark, docs, items)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in found)[0] == (1, 200_055, 55, 10)


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert not decontaminate.contamination(docs, items.limit(0)).where("contaminated").count()


def test_documents_and_spans_are_removed(spark):
    docs, items = frames(spark)
    bad = {str(r[0]) for r in brute(DOCS, ITEMS) if r[5]}
    left = decontaminate.decontaminated(docs, items)
    assert left.columns == docs.columns
    assert {str(r.doc_id) for r in left.collect()} == {str(d) for d, _ in DOCS} - bad
    cut = {r.doc_id: r.text for r in decontaminate.without_spans(docs, items).collect()}
    assert cut[1] == "intro " + " " * 29 + " end" and cut[5] == "  !" + " " and cut[3] is None and cut[8] == DOCS[9][1]
