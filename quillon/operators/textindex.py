"""Text filters: token postings in blocks, matched before a search.

A text passes a filter that it shares every token with. Ids are hashed into slices of a few
thousand, and a block holds the ids of one token within one slice: a token that every text
has is spread over all slices, and a conjunction is settled inside a slice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quillon.operators.numbering import global_index
from quillon.session import fresh_path, materialize

TOKEN = r"[\p{L}\p{N}]+"
#: Ids a slice holds on average, and postings a folder of tokens should hold.
SLICE_IDS = 8_192
FOLDER_POSTINGS = 16_000_000
MAX_FOLDERS = 256
#: Distinct filter tokens that are written into the scan's own filter.
PUSHED_TOKENS = 1_000


def tokens(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits; none for a null text."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    return F.array_distinct(F.coalesce(found, F.array().cast("array<string>")))


def _bucket(value: str, n: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(n)).cast("int")


@dataclass(frozen=True)
class TextIndex:
    """Written blocks (token, slice, ids), in folders by a hash of the token."""

    blocks: DataFrame
    path: str
    slices: int
    folders: int


def build_text_index(texts: DataFrame, *, id_column: str = "record_id", text_column: str = "text", slice_ids: int = SLICE_IDS) -> TextIndex:
    """Write the postings of every text.

    Rows with a null id are left out. Texts of a repeated id count as one text. A task
    counts each (token, id) once before the shuffle, which is by (token, slice); blocks are
    ranged by token, so that the scan skips those of other tokens by their files' statistics.
    """
    spark = texts.sparkSession
    rows = texts.select(F.col(id_column).alias("id"), tokens(F.col(text_column)).alias("tokens")).where("id IS NOT NULL")
    rows = materialize(rows, "tokens")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("tokens").cast("long")).alias("postings")).first()
    slices = max(1, -(-size.n // slice_ids))
    folders = min(MAX_FOLDERS, 1 + (size.postings or 0) // FOLDER_POSTINGS)
    placed = rows.select(F.explode("tokens").alias("token"), _bucket("id", slices).alias("slice"), "id")
    blocks = placed.groupBy("token", "slice").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    # Ranges are sampled from the blocks first, so they are written before.
    blocks = materialize(blocks.withColumn("folder", _bucket("token", folders)), "blocks")
    path = fresh_path(spark, "postings")
    order = ["folder", "token", "slice"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.partitionBy("folder").parquet(path)
    return TextIndex(spark.read.schema(blocks.schema).parquet(path), path, slices, folders)


def blocks_of(index: TextIndex, wanted: DataFrame) -> DataFrame:
    """Blocks (token, slice, ids) of the wanted tokens, with the other columns of ``wanted``.

    Up to a checked number of distinct tokens the scan itself opens only their folders and
    row groups; beyond it the join alone selects.
    """
    asked = [r[0] for r in wanted.select("token").distinct().limit(PUSHED_TOKENS + 1).collect()]
    blocks = index.blocks
    if len(asked) <= PUSHED_TOKENS:
        names = index.blocks.sparkSession.createDataFrame([(t,) for t in asked], "token string")
        folders = [r[0] for r in names.select(_bucket("token", index.folders)).distinct().collect()]
        blocks = blocks.where(F.col("folder").isin(folders) & F.col("token").isin(asked))
    return blocks.drop("folder").join(wanted, "token")


@dataclass(frozen=True)
class TermMatches:
    """Matches without their pairs: a filter passes an id that holds all terms it needs.

    ``held`` (id, terms) has one row per id that holds any needed term, ``needed`` (filter_id,
    terms) one per filter. Both are as large as the postings and the filters, whereas pairs
    grow with the product of texts and filters.
    """

    held: DataFrame
    needed: DataFrame


def term_matches(index: TextIndex, filters: DataFrame, *, filter_id: str = "filter_id", text: str = "text") -> TermMatches:
    """What ``text_matches`` finds, as terms: every asked posting travels once, to its id."""
    asked = filters.select(F.col(filter_id).alias("filter_id"), F.explode(tokens(F.col(text))).alias("token")).where("filter_id IS NOT NULL")
    asked = materialize(asked.distinct(), "asked")
    names = materialize(global_index(asked.select("token").distinct(), ["token"], "term"), "terms")
    needed = asked.join(names, "token").groupBy("filter_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    postings = blocks_of(index, names).select("term", F.explode("ids").alias("id"))
    held = postings.groupBy("id").agg(F.collect_list("term").alias("terms"))
    return TermMatches(held, materialize(needed, "needed"))


def text_matches(
    index: TextIndex, filters: DataFrame, *, filter_id: str = "filter_id", text: str = "text", paired: bool = True,
) -> DataFrame | TermMatches:
    """(filter_id, id): texts that hold every token of a filter's text, each pair once.

    Without ``paired`` the same matches as :class:`TermMatches`, for a search that needs no pairs.

    A filter without tokens, or with a null id, passes nothing; of a repeated filter id every
    text must be met as if they were one. Slices that lack one of a filter's tokens drop out
    before any id is looked at; a group then holds, per token, the ids of one slice.
    """
    if not paired:
        return term_matches(index, filters, filter_id=filter_id, text=text)
    asked = filters.select(F.col(filter_id).alias("filter_id"), F.explode(tokens(F.col(text))).alias("token")).where("filter_id IS NOT NULL")
    asked = asked.distinct()
    needs = asked.groupBy("filter_id").agg(F.count(F.lit(1)).alias("need"))
    wanted = materialize(asked.join(needs, "filter_id"), "filters")
    met = blocks_of(index, wanted)
    whole = met.groupBy("filter_id", "slice").agg(F.count(F.lit(1)).alias("have"), F.first("need").alias("need")).where("have = need")
    lists = met.drop("need").join(whole.select("filter_id", "slice"), ["filter_id", "slice"])
    grouped = lists.groupBy("filter_id", "slice").agg(F.sort_array(F.collect_list(F.struct(F.size("ids").alias("n"), "ids"))).alias("lists"))
    first = F.col("lists")[0]["ids"]  # the shortest
    both = F.aggregate(F.slice("lists", 2, F.greatest(F.size("lists") - 1, F.lit(0))), first, lambda kept, row: F.array_intersect(kept, row["ids"]))
    return grouped.select("filter_id", F.explode(both).alias("id"))
