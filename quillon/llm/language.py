"""Language of web pages by fusing the evidence of text, markup, address and host."""

from __future__ import annotations

import functools
import html as markup
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quillon.session import materialize

BUCKETS = 1 << 15
#: Pseudo counts of the level above in the prior of a suffix and of a host.
SUFFIX_WEIGHT, HOST_WEIGHT = 50.0, 10.0
#: Words depend on each other: a text counts as so many independent words at most.
TEXT_WORDS = 40.0
#: Different languages a model may tell apart.
LANGUAGES = 1000

_OPEN = re.compile(r"(?i)<(?:(script|style|nav|noscript|template)\b|!--)")
_CLOSE = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "nav", "noscript", "template")}
_CLOSE[""] = re.compile("-->")
_TAG = re.compile(r"<[^<>]*>")
_WORD = re.compile(r"[^\W\d_]+")


def _without_skipped(page: str) -> str:
    """The page without comments and skipped elements that are closed, each a space instead.

    What has no end further on stays; it is looked for once per kind, so that the time is
    linear in the page.
    """
    kept, start, at, endless = [], 0, 0, set()
    while opened := _OPEN.search(page, at):
        name = (opened[1] or "").lower()
        closed = None if name in endless else _CLOSE[name].search(page, opened.end())
        at = closed.end() if closed else opened.end()
        if closed:
            kept.append(page[start : opened.start()])
            start = at
        else:
            endless.add(name)
    return " ".join([*kept, page[start:]])


def visible(page: str) -> str:
    """Text between the tags, without scripts, styles and navigation."""
    return markup.unescape(_TAG.sub(" ", _without_skipped(page)))


def buckets(text: str) -> np.ndarray:
    words = _WORD.findall(text.lower())
    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) & (BUCKETS - 1) for w in words), np.int64, len(words))


def _counted(batches: Iterator[pa.RecordBatch], langs: list[str]) -> Iterator[pa.RecordBatch]:
    """Word counts of a partition by language and bucket: combined before the shuffle."""
    at = {lang: i for i, lang in enumerate(langs)}
    counts = np.zeros((len(langs), BUCKETS), np.int64)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[at[lang]] += np.bincount(buckets(text), minlength=BUCKETS)
    lang, bucket = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(counts[lang, bucket])], names=["lang", "bucket", "n"])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log likelihood of each word bucket in each) from all documents with both
    a text and a language. The model's size is fixed: LANGUAGES times BUCKETS at most."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    langs = sorted(r[0] for r in rows.select("lang").distinct().limit(LANGUAGES + 1).collect())
    if len(langs) > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} languages")
    counts = np.zeros((len(langs), BUCKETS))
    if langs:
        found = rows.mapInArrow(functools.partial(_counted, langs=langs), "lang int, bucket int, n long").groupBy(
            "lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
        counts[found["lang"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    likely = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
    return langs, np.log(likely)


def _scored(batches: Iterator[pa.RecordBatch], model: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores, votes, sizes = [], [], []
        for page in batch.column("html").to_pylist():
            found = buckets(visible(page or ""))
            total = model[:, found].sum(axis=1) if len(found) else np.zeros(len(model))
            scores.append(total * min(1.0, TEXT_WORDS / max(1, len(found))))
            votes.append(int(total.argmax()) if len(found) else None)
            sizes.append(len(found))
        keep = [n for n in batch.schema.names if n != "html"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in keep), pa.array(scores, pa.list_(pa.float64())), pa.array(votes, pa.int32()), pa.array(sizes, pa.int64())],
            names=[*keep, "likely", "vote", "n_words"])


def _counts(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """One row per key with the votes for each language, as an array."""
    each = [F.sum((F.col("vote") == i).cast("long")).alias(f"n{i}") for i in range(n)]
    return rows.where("vote IS NOT NULL").groupBy(*keys).agg(*each).select(*keys, F.array(*(F.col(f"n{i}") for i in range(n))).alias("votes"))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, lang, confidence, declared, host, text_lang, n_words) of every page.

    The posterior of a language is the product of: the text's likelihood under word
    frequencies learnt from ``docs`` (tempered to TEXT_WORDS words); the likelihood of the
    declared markup language, learnt from how often pages of each text language declare it;
    and the prior of the host. A host's prior is its pages' text votes, without the page's
    own, smoothed by the votes of its address suffix (the last two labels), which are
    smoothed by all votes. All counts are grouped aggregations, and only counts are joined.

    A page without html, or without words, votes for nothing and follows markup and host; a
    null or unreadable url has the empty host. Repeated rows and null ids are rows like
    others. Without training documents lang is null; no pages, no rows.
    """
    langs, model = train(docs)
    n = len(langs)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)", 1))
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), "(?i)<html[^<>]*?\\slang\\s*=\\s*[\"']?([a-zA-Z]+)", 1))
    rows = pages.select("page_id", host.alias("host"), F.regexp_extract(host, "([^.]+\\.)?[^.]*$", 0).alias("suffix"), declared.alias("declared"), "html")
    if not n:
        none = F.lit(None).cast("string")
        return rows.select("page_id", none.alias("lang"), F.lit(0.0).alias("confidence"), "declared", "host", none.alias("text_lang"), F.lit(0).cast("long").alias("n_words"))
    schema = "page_id long, host string, suffix string, declared string, likely array<double>, vote int, n_words long"
    scored = materialize(rows.withColumn("page_id", F.col("page_id").cast("long")).mapInArrow(functools.partial(_scored, model=model), schema), "scored")

    # Languages times declared values that are languages: a table of bounded size.
    marks = F.when(F.col("declared").isin(langs), F.col("declared")).otherwise("")
    table = scored.where("vote IS NOT NULL").groupBy("vote", marks.alias("mark")).count().collect()
    told = {(r["vote"], r["mark"]): r["count"] for r in table}
    sums = [sum(told.get((i, m), 0) for m in ["", *langs]) for i in range(n)]
    chance = {m: [float(np.log((told.get((i, m), 0) + 1) / (sums[i] + n + 1))) for i in range(n)] for m in ["", *langs]}
    whole = sum(sums)
    top = F.array(*(F.lit((s + 1) / (whole + n)) for s in sums))

    suffixes = materialize(_counts(scored, ["suffix"], n).withColumnRenamed("votes", "suffix_votes"), "suffixes")
    hosts = materialize(_counts(scored, ["host"], n).withColumnRenamed("votes", "host_votes"), "hosts")
    met = scored.join(hosts, "host", "left").join(suffixes, "suffix", "left")
    none = F.array_repeat(F.lit(0).cast("long"), n)
    own = F.array(*((F.col("vote").eqNullSafe(F.lit(i))).cast("long") for i in range(n)))

    def less(votes: str):
        return F.zip_with(F.coalesce(F.col(votes), none), own, lambda a, b: (a - b).cast("double"))

    def smoothed(votes, above, weight: float):
        total = F.aggregate(votes, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(votes, above, lambda x, p: (x + F.lit(weight) * p) / (total + F.lit(weight)))

    met = met.withColumn("suffix_prior", smoothed(less("suffix_votes"), top, SUFFIX_WEIGHT))
    met = met.withColumn("prior", smoothed(less("host_votes"), F.col("suffix_prior"), HOST_WEIGHT))
    mark = F.lit(None).cast("array<double>")
    for m, values in chance.items():
        mark = F.when(marks == m, F.array(*(F.lit(v) for v in values))).otherwise(mark)
    met = met.withColumn("evidence", F.zip_with(F.zip_with("likely", "prior", lambda a, p: a + F.log(p)), mark, lambda a, b: a + b))
    best = F.array_max("evidence")
    mass = F.aggregate("evidence", F.lit(0.0), lambda a, x: a + F.exp(x - best))
    names = F.array(*(F.lit(x) for x in langs))
    return met.select(
        "page_id", F.element_at(names, F.array_position("evidence", best).cast("int")).alias("lang"),
        F.round(1 / mass, 6).alias("confidence"), "declared", "host",
        F.when(F.col("vote").isNotNull(), F.element_at(names, F.col("vote") + 1)).alias("text_lang"), "n_words")
