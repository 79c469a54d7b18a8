"""Filter interaction audit: what each filter removes under every order of the filters."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillon.session import materialize

FILTERS = "ABCDE"
#: Hashes of repeated texts that may travel to the scan (16 bytes each in a task's table).
BROADCAST_HASHES = 1_000_000
#: Rows of one text that meet in one task of the existential join.
SALT_ROWS = 50_000
_MARKS = b"#$%&*|"


def failed_bits(data: bytes | None) -> int:
    """Bits 0 to 3: the filters A to D that the text fails."""
    data = data or b""
    words = data.split()
    signs = np.frombuffer(data, np.uint8)
    points = int(np.count_nonzero((signs & 0xC0) != 0x80))
    capitals = int(np.count_nonzero((signs >= 65) & (signs <= 90)))
    return (
        (len(words) < 100)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * capitals > 10 * points) << 2
        | any(m in data for m in _MARKS) << 3
    )


def _failed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = [failed_bits(t.as_py()) for t in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(bits, pa.int32())], names=[*batch.schema.names[:-1], "bits"])


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, part, h, text): null texts and languages are empty ones."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("h"), text.alias("text"))


def copies(rows: DataFrame) -> DataFrame:
    """Distinct (doc_id, h) of the rows whose text a row with a smaller id holds as well.

    A left-semi join on the hash, the exact text and a smaller id. Its right side is one row
    per repeated text with the least id, aggregated before the shuffle, so a text that a
    third of the table holds travels once per task. Where all texts of a hash are equal,
    which that aggregation shows, equal hashes are equal texts and the left side needs no
    text; only rows of hashes that two texts share bring theirs. Rows of one text are dealt
    to as many tasks as they fill.
    """
    keys = rows.select("doc_id", "h").where("doc_id IS NOT NULL")
    seen = keys.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n"))
    repeated = materialize(seen.where("lo < hi").select("h", "n"), "repeated")
    held = repeated.select(F.col("h").alias("_h"))
    if repeated.count() <= BROADCAST_HASHES:
        held = F.broadcast(held)
    met = rows.where("doc_id IS NOT NULL").join(held, F.col("h") == F.col("_h"), "left_semi")
    firsts = materialize(met.groupBy("h", "text").agg(F.min("doc_id").alias("first")), "firsts")
    shared = materialize(firsts.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("h"), "shared")
    salts = F.ceil(F.col("n") / SALT_ROWS).cast("int")

    def later(left: DataFrame, right: DataFrame, *on: str) -> DataFrame:
        """Rows of ``left`` for which ``right`` holds the same key with a smaller id."""
        wide = right.join(repeated, "h").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        wide = wide.select(*(F.col(c).alias(f"r_{c}") for c in on), "first", F.col("salt").alias("r_salt"))
        dealt = left.join(repeated, "h").withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts).cast("int"))
        same = F.col("first") < F.col("doc_id")
        for c in (*on, "salt"):
            same = same & (F.col(c) == F.col(f"r_{c}"))
        return dealt.join(wide, same, "left_semi").select("doc_id", "h")

    plain = later(keys, firsts.join(shared, "h", "left_anti"), "h")
    clash = later(met.join(shared, "h", "left_semi").select("doc_id", "h", "text"), firsts.join(shared, "h", "left_semi"), "h", "text")
    return plain.unionByName(clash).distinct()


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): rows per set of failed filters, bit i being filter i.

    ``good`` of them have a label quality = 1, ``toxic`` a label toxic = 1.
    """
    rows = _rows(docs)
    own = materialize(rows.withColumn("text", F.col("text").cast("binary")).mapInArrow(_failed, "doc_id long, part string, h long, bits int").groupBy(
        "doc_id", "part", "h", "bits").agg(F.count(F.lit(1)).alias("n")), "failed")
    marked = materialize(copies(rows).select("doc_id", "h"), "copies")
    # Equal keys are equal texts, so a key's rows share their bits.
    every = own.unionByName(marked.select(
        "doc_id", F.lit(None).cast("string").alias("part"), "h", F.lit(1 << 4).alias("bits"), F.lit(0).cast("long").alias("n")))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    masks = every.groupBy("doc_id", "h").agg(
        F.bit_or("bits").alias("bits"), F.collect_list(F.when(F.col("part").isNotNull(), F.struct("part", "n"))).alias("held"))
    each = masks.join(known, F.col("doc_id") == F.col("_id"), "left").select("bits", "good", "toxic", F.inline("held"))
    count = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c)
    return each.groupBy("part", "bits").agg(F.sum("n").alias("n"), count("good"), count("toxic"))


def orders() -> list[tuple[str, int, int, int]]:
    """(order, step, filter bit, bits of the filters before it) for all orders and steps."""
    out = []
    for order in itertools.permutations(range(len(FILTERS))):
        for step, i in enumerate(order):
            out.append(("".join(FILTERS[j] for j in order), step + 1, 1 << i, sum(1 << j for j in order[:step])))
    return out


_AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def _followed(table: pa.Table) -> pa.Table:
    """Every order of the filters over one part's counts: 32 rows at most."""
    bits, n, good, toxic = (table[c].to_numpy() for c in ("bits", "n", "good", "toxic"))
    # Of the filters that a row fails, each stands first in equally many orders.
    share = n * (math.factorial(len(FILTERS)) // np.maximum(1, np.bitwise_count(bits)))
    found = []
    for order, step, f, earlier in orders():
        fails, before = bits & f != 0, bits & earlier != 0
        gone = fails & ~before
        found.append((order, step, n[~fails & ~before].sum(), n[gone].sum(), n[fails & before].sum(), n[bits == f].sum(),
                      good[gone].sum(), toxic[gone].sum(), share[fails].sum()))
    columns = [[table["part"][0].as_py()] * len(found), *zip(*found)]
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
    names = [field.split()[0] for field in _AUDIT.split(", ")]
    return pa.table({name: pa.array(column, kind) for name, column, kind in zip(names, columns, kinds)})


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    Filters: A under 100 words; B distinct words under 80 of 100; C capitals over 10 of 100
    code points; D a character of #$%&*|; E the text of a smaller doc_id anywhere. Every
    order of the five is followed over the counts of failure sets (32 per part), not over
    rows. ``shapley`` sums what the step's filter removes over all orders: of a row that
    fails k filters each of them removes it in 120 / k orders.

    A null text is empty (it fails A, and E where a smaller id has an empty text), a null
    lang is part ''. Rows are documents: repeated rows count each, also under one id, and a
    row is no copy of one with the same id. A null id has no labels and is neither a copy
    nor copied from. With several labels an id is good or toxic if one says so. Other
    columns are ignored. Empty documents have no parts and give no rows.
    """
    return combinations(docs, labels).groupBy("part").applyInArrow(_followed, _AUDIT)
