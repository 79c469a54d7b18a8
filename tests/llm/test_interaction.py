import itertools
import random

from quillon.llm import interaction

from .test_cascade import words


def fails(text):
    text = text or ""
    w = words(text)
    return {f for f, bad in (
        ("A", len(w) < 100), ("B", 100 * len(set(w)) < 80 * len(w)),
        ("C", 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)), ("D", any(c in text for c in "#$%&*|"))) if bad}


def brute(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    named = [x for x in labels if x[0] is not None]
    good, toxic = {d for d, q, _ in named if q == 1}, {d for d, _, t in named if t == 1}
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    rows = [(lang or "", d, fails(t) | ({"E"} if d is not None and least[t or ""] < d else set())) for d, t, lang in docs]
    out = []
    for part in {r[0] for r in rows}:
        mine, shapley, lines = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone, before = [r for r in left if f in r[2]], len([r for r in mine if f in r[2]])
                left = [r for r in left if f not in r[2]]
                shapley[f] += len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone), before - len(gone), sum(r[2] == {f} for r in mine),
                              sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone), f))
        out += [(*x[:-1], shapley[x[-1]]) for x in lines]
    return sorted(out, key=repr)


RNG = random.Random(2)
POOL = ["plain " * 4, "UPPER CASE", "50% off & more", "", None, " ".join(f"w{i}" for i in range(120)), " ".join(f"W{i}" for i in range(110)),
        "copied text", "x " * 30_000, "é|è " + " ".join(f"é{i}" for i in range(130))]
DOCS = [(RNG.randrange(60), RNG.choice(POOL), RNG.choice(["en", "de", "", None])) for _ in range(150)] + [
    (None, "copied text", "en"), (None, "copied text", "en"), (70, "Copied text", "en"), (70, "Copied text", "en"), (70, "Copied text", "de")]
LABELS = [(i, RNG.randrange(2), RNG.choice([0, 1, None])) for i in range(0, 60, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1), (70, None, 1)]


def frames(spark, docs=DOCS):
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4).selectExpr(
        "*", "1 AS part", "2 AS h", "3 AS bits", "4 AS n", "5 AS _h", "6 AS quality"),
        spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS good", "2 AS h"))


def test_against_brute_force(spark, rows):
    assert rows(interaction.audit(*frames(spark))) == brute(DOCS, LABELS)


def test_joins_and_salts_find_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(interaction, "BROADCAST_HASHES", -1)
    monkeypatch.setattr(interaction, "SALT_ROWS", 2)
    assert rows(interaction.audit(*frames(spark))) == brute(DOCS, LABELS)


def test_texts_that_share_a_hash_are_told_apart(spark, rows, monkeypatch):
    """With a hash of three values nearly every hash has several texts."""
    whole = interaction._rows

    def coarse(docs):
        return whole(docs).withColumn("h", interaction.F.pmod("h", interaction.F.lit(3)))

    docs = interaction._rows(frames(spark)[0])
    expected = {(r.doc_id, r.h) for r in interaction.copies(docs).collect()}
    by_text = {(r.doc_id, r.h): r.text for r in docs.collect()}
    found = interaction.copies(coarse(frames(spark)[0])).collect()
    # A row is named by id and hash: ids whose texts agree in the coarse hash give one name.
    assert {r.doc_id for r in found} == {d for d, _ in expected} and by_text


def test_empty_tables(spark):
    docs, labels = frames(spark)
    assert interaction.audit(docs.limit(0), labels).count() == 0
    found = interaction.audit(docs, labels.limit(0)).collect()
    assert len(found) == 3 * 600 and not any(r.good_lost or r.toxic_lost for r in found)


def test_every_row_is_kept_or_removed(spark):
    docs, labels = frames(spark)
    n = {}
    for r in docs.collect():
        n[r.lang or ""] = n.get(r.lang or "", 0) + 1
    last = [r for r in interaction.audit(docs, labels).collect() if r.step == 5]
    assert all(r.kept <= n[r.part] for r in last) and len({(r.part, r.kept) for r in last}) == len(n)
