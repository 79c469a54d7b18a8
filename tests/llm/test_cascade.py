import random
from collections import Counter

from quillon.llm import cascade, queries

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    for c in SPACE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(text):
    """Measures and verdict from their definitions."""
    text = text or ""
    w = words(text)
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(runs)
    repeated = {i + j for i, r in enumerate(runs) if often[r] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines)) if len(lines) < 500 else len(lines) - len(set(lines))
    n, chars, symbols = len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>")
    base = n < 10 or 100 * len(repeated) > 20 * n
    kept = not (base or 10 * symbols > n or not 2 * n <= chars <= 15 * n or 2 * dup > len(lines))
    return n, chars, symbols, dup, len(repeated), base, kept


RNG = random.Random(3)
TEXTS = [
    None, "", " \t\r\n\x0b\x0c", "one", "a b c d e " * 3, "wörter und sätze " * 9, "#*$%&|<> " * 20, "né\x85e x " * 12,
    "\n".join(["same line here"] * 4), "x\n \nx\nx \nx", "longwordwithoutanyspace" * 50, " ".join(f"w{i}" for i in range(60_000)),
    "pad " + "r0 r1 r2 r3 r4 " * 20_000, " ".join(RNG.choice("abcdef") for _ in range(400)),
    *(" ".join(RNG.choice(["alpha", "beta", "gamma", "delta", "#tag", "line\n"]) for _ in range(RNG.randrange(3, 60))) for _ in range(60)),
    "clean words of a plain text that says one thing after another and stops", "clean words of a plain text that says one thing after another and stops",
]


def frame(spark, texts=TEXTS):
    rows = [(None if i % 7 == 0 else i // 2, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS row", "2 AS rejected_by", "3 AS n_words", "4 AS _text", "'k' AS kept")


def test_against_brute_force(spark, rows):
    found = rows(cascade.quality_rules(frame(spark)))
    expected = [(r.doc_id, *brute(r.text)) for r in frame(spark).collect()]
    assert found == sorted(expected, key=repr)


def test_order_and_names_change_nothing_else(spark):
    docs = frame(spark)
    full = {(r.row.doc_id, r.row.text): r.rejected_by for r in cascade.judged(docs, order=[0, 1, 2, 3, 4]).collect()}
    turned = {(r.row.doc_id, r.row.text): r.rejected_by for r in cascade.judged(docs, order=[4, 3, 2, 1, 0]).collect()}
    assert {k for k, v in full.items() if v is None} == {k for k, v in turned.items() if v is None}
    assert any(full[k] != turned[k] for k in full)
    kept = cascade.accepted(docs, order=[2, 0, 1, 3, 4])
    assert kept.columns == docs.columns and kept.count() == sum(brute(r.text)[-1] for r in docs.collect())


def test_later_rules_are_not_tried(spark):
    def never(page):
        raise AssertionError("tried")

    docs = spark.createDataFrame([(1, "a"), (2, "b c")], "doc_id long, text string")
    rules = (cascade.Rule("never", never), cascade.Rule("all", lambda p: True))
    assert {r.rejected_by for r in cascade.judged(docs, rules, order=[1, 0]).collect()} == {"all"}


def test_rank_is_rejection_per_cost_of_what_is_left():
    # Rule 0 rejects most but is dear; 1 is cheap; 2 rejects only what 1 rejects as well.
    patterns = [(0b001, 60, [600, 6, 1]), (0b110, 30, [300, 3, 1]), (0b000, 10, [100, 1, 1])]
    assert cascade.ranked(patterns, 3) == [2, 0, 1]
    assert cascade.ranked([(0b011, 5, [5, 5])], 2) == [0, 1] and cascade.ranked([], 2) == [0, 1]


def test_estimate_puts_cheap_rejecting_rules_first(spark):
    def slow(page):
        return len(page.words) > 0 and sum(range(20_000)) < 0

    rules = (cascade.Rule("slow", slow), cascade.Rule("short", lambda p: len(p.data) < 50))
    docs = spark.createDataFrame([(i, "word " * (i % 20)) for i in range(200)], "doc_id long, text string")
    assert cascade.estimate(docs, rules) == [1, 0]
    assert sorted(cascade.estimate(docs.limit(0), rules)) == [0, 1]


def test_empty_table(spark):
    assert cascade.quality_rules(frame(spark).limit(0)).count() == 0


def test_registered_query_reads_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    found = sorted(map(tuple, queries.QUERIES["op11_cascade"](spark, sf).collect()))
    assert found == sorted((r.doc_id, *brute(r.text)) for r in docs)
