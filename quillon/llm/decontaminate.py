"""Benchmark decontamination: documents that hold passages of test items. JVM-side only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quillon.session import materialize

WINDOW = 10
#: Windows that travel to a scan of the documents (about 200 bytes each); a benchmark of
#: more windows is met in blocks, one scan each.
BROADCAST_WINDOWS = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits and all other characters; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN), "")


def _hash(place: Column, length: int) -> Column:
    """Hash of the ``length`` words from a zero-based place on, without making the window."""
    return F.xxhash64(F.lit(length), *(F.get("words", place + i) for i in range(length)))


def _placed(rows: DataFrame, lengths: Sequence[int], *keep: str) -> DataFrame:
    """A row for each place of each document (-1 stands for the document itself), and for
    each window length a row with the hash ``h`` of the window there, null past the end.

    The words are split once; a row holds a reference to them, not a copy.
    """
    each = rows.select(*keep, "words", F.explode_outer(F.sequence(F.lit(-1), F.size("words") - 1)).alias("place"))
    inside = lambda n: (F.col("place") >= 0) & (F.col("place") + n <= F.size("words"))
    if len(lengths) == 1:
        return each.select("*", F.lit(lengths[0]).alias("long"), F.when(inside(lengths[0]), _hash(F.col("place"), lengths[0])).alias("h"))
    hashes = F.array(*(F.struct(F.lit(n).alias("long"), F.when(inside(n), _hash(F.col("place"), n)).alias("h")) for n in lengths))
    return each.select("*", F.explode(hashes).alias("w")).select(*each.columns, "w.long", "w.h")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h, run, long, items): each distinct window of the items with the ids that hold it.

    An item of fewer words than a window is one window; one without words has none.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words"))
    runs = None
    for n in range(1, window + 1):
        mine = items.where(F.size("words") >= n if n == window else F.size("words") == n)
        placed = _placed(mine, [n], "item").where("h IS NOT NULL")
        part = placed.select("h", "long", F.slice("words", F.greatest(F.col("place") + 1, F.lit(1)), F.lit(n)).alias("run"), "item")
        runs = part if runs is None else runs.unionByName(part)
    # Items of one window are few: a test passage is not a key of the documents.
    return runs.groupBy("h", "long", "run").agg(F.sort_array(F.collect_set("item")).alias("items"))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per distinct (doc_id, text): n_words, its hits (place, length) and items.

    All windows of a document are hashed and met with the benchmark's hashes inside the
    scan's stage, in time linear in the text; a window is made only where a hash is met,
    and must agree in its words. Only hits and one row per document are shuffled, whatever
    the size of the benchmark. ``copies`` counts equal rows.
    """
    held = materialize(benchmark_windows(benchmark, window), "windows")
    lengths = sorted(r[0] for r in held.select("long").distinct().collect()) or [window]  # at most ``window`` values
    blocks = max(1, -(-held.count() // BROADCAST_WINDOWS))
    rows = docs.select(F.col("doc_id"), F.xxhash64("text").alias("key"), F.octet_length("text").alias("bytes"), words(F.col("text")).alias("words"))
    placed = _placed(rows, lengths, "doc_id", "key", "bytes")
    found = None
    for block in range(blocks):
        table = held.where(F.pmod("h", F.lit(blocks)) == block)
        table = F.broadcast(table.select(F.col("h").alias("_h"), F.col("run").alias("_run"), "items"))
        same = F.slice("words", F.greatest(F.col("place") + 1, F.lit(1)), F.col("long")) == F.col("_run")
        # The hash alone is the key of the join; only rows that meet one make their window.
        met = placed.join(table, F.col("h") == F.col("_h"), "left").where((F.col("place") == -1) | (F.col("_h").isNotNull() & same))
        met = met.where("place >= 0 OR long = %d" % (lengths[0] if block == 0 else -1)).select(
            "doc_id", "key", "bytes", F.size("words").alias("n_words"), "place", "long", "items")
        found = met if found is None else found.unionByName(met)
    hit = F.when(F.col("place") >= 0, F.struct("place", "long"))
    # Both lists are bounded by one document and by the benchmark.
    return found.groupBy("doc_id", "key", "bytes").agg(
        F.max("n_words").alias("n_words"), F.sum((F.col("place") < 0).cast("long")).alias("copies"),
        F.sort_array(F.collect_set(hit)).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def _covered(hits: str) -> Column:
    """Number of places in the union of sorted spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        hits, start,
        lambda a, h: F.struct(
            F.greatest(a["end"], h["place"] + h["long"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), h["place"] + h["long"] - F.greatest(a["end"], h["place"]))).alias("n")),
        lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: n_words, n_hit, n_items, items_sha256, contaminated.

    Null texts, and those without words, have no words and no hits. Rows may repeat and
    ids may be null or shared: each row is judged by its own text and returned. Item ids
    sort as strings; a null item id counts for hits but not as an item. An empty benchmark
    hits nothing; empty documents give no rows. Other columns are ignored.
    """
    found = matches(docs, benchmark, window)
    each = found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"))
    return each.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), _covered("hits").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    bad = matches(docs, benchmark, window).where(F.size("hits") > 0).select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("bytes").alias("_bytes"))
    bad = materialize(bad, "contaminated")
    same = docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_key"]) & F.octet_length(docs["text"]).eqNullSafe(bad["_bytes"])
    return docs.join(bad, same, "left_anti")


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the words of the benchmark's windows cut out of the texts.

    What stands between words stays. Texts without hits are returned as they are.
    """
    hits = materialize(matches(docs, benchmark, window).where(F.size("hits") > 0).select("doc_id", "key", "bytes", "hits"), "hits")
    # Columns of the documents stay in a struct, so that their names can't clash.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).alias("d")
    text, h = F.col("row.text"), hits.alias("h")
    same = F.col("row.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.xxhash64(text) == F.col("h.key")) & F.octet_length(text).eqNullSafe(F.col("h.bytes"))
    met = rows.join(h, same, "left").select("row", "hits")
    own = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
    runs, gaps = F.regexp_extract_all(text, F.lit(own), F.lit(0)), F.split(text, own)
    kept = F.zip_with(gaps, F.transform(runs, lambda w, i: F.when(
        F.exists("hits", lambda x: (x["place"] <= i) & (i < x["place"] + x["long"])), F.lit("")).otherwise(w)),
        lambda g, w: F.concat(F.coalesce(g, F.lit("")), F.coalesce(w, F.lit(""))))
    cut = F.when(F.col("hits").isNotNull(), F.array_join(kept, "")).otherwise(text)
    return met.select(F.col("row").withField("text", cut).alias("row")).select("row.*")
