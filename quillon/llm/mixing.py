"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillon.operators.numbering import global_index
from quillon.session import materialize

#: A source is repeated this often at most.
MOST = 3
#: More sources than this are joined by a shuffle instead of a broadcast (24 bytes each).
BROADCAST_SOURCES = 100_000
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text_column: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(totals: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, ... ``cycle``, repeating, over sources in code point order, null last."""
    ordered = totals.withColumn("_null", F.col("source").isNull()).withColumn("_key", F.coalesce("source", F.lit("")))
    placed = global_index(ordered, ["_null", "_key"], "_place")
    return placed.withColumn("weight", (F.pmod("_place", F.lit(cycle)) + 1).cast("double")).drop("_null", "_key", "_place")


def targets(weighted: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate) from (source, source_size, weight).

    The total is shared by weight; what exceeds ``most`` times a source's size is shared
    again among the rest until none is above. A round is one aggregation giving a few
    sums, and every round caps a source for good. A total that cannot be placed (all
    sources capped) is left out. Sources of size or weight 0 get 0.
    """
    weighted = materialize(weighted, "weights")
    size, weight = F.col("source_size").cast("double"), F.col("weight")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        capped = level * weight >= most * size
        free = F.when(~capped, weight).otherwise(0.0)
        taken, open_weight = weighted.agg(
            F.sum(F.when(capped, most * size).otherwise(0.0)), F.sum(free)).first()
        if not open_weight:
            break
        new = (total - taken) / open_weight
        if new <= level:
            break
        level = new
    target = F.least(F.lit(level) * weight, most * size)
    rate = F.when(size > 0, F.when(target >= most * size, F.lit(float(most))).otherwise(target / size)).otherwise(0.0)
    return weighted.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def chance(id_column: str, text_column: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the seed, the id and the text alone."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_column).cast("string"), F.lit("null")),
                      F.md5(F.coalesce(F.col(text_column), F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def repetitions(docs: DataFrame, weights=cycled_weights, seed: int = 42, id_column: str = "doc_id",
                text_column: str = "text", source_column: str = "source", keep: bool = False) -> DataFrame:
    """Each document with its size, its source's size and target, and how often it is taken.

    ``weights`` gives (source, source_size, weight) from (source, source_size). A document
    is taken floor(rate) times, rate being target over source size, and once more with the
    fraction as chance, drawn from a hash of seed, id and text: reruns agree, and rows that
    repeat an id and a text draw alike. Null texts and texts without words have size 0 and
    count nothing; a null source is a source; an empty table gives no rows. Only rates are
    joined, so a source of any share is never gathered. ``keep`` adds all columns of
    ``docs`` (in a struct ``row``).
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), word_count(text_column).alias("size"),
        chance(id_column, text_column, seed).alias("_chance"), *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if keep else []))
    if not keep:
        rows = materialize(rows, "sizes")
    totals = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "totals")
    rates = materialize(targets(weights(totals)), "rates").withColumnRenamed("source", "_source")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    met = rows.join(rates, rows["source"].eqNullSafe(rates["_source"]), "left")
    whole = F.floor("rate")
    copies = whole + (F.col("_chance") < F.col("rate") - whole).cast("long")
    return met.select("doc_id", "size", "source", "source_size", "target",
                      F.coalesce(copies, F.lit(0)).cast("int").alias("copies"), *(["row"] if keep else []))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as ``repetitions`` says, with all columns."""
    counted = repetitions(docs, keep=True, **options).where("copies > 0")
    return counted.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("row.*")
