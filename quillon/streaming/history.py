"""Keys seen so far, by bucket, behind bit sieves that tell which buckets a batch can hit."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillon.session import materialize
from quillon.sources.epochs import earlier_epochs, read_epochs, write_epoch

#: Bits of one bitmap, as Spark's bitmap functions build them, and bits set per key.
BITMAP_BITS = 32768
PROBES = 4


@dataclass(frozen=True)
class KeyHistory:
    """Record ids of earlier epochs.

    Ids lie in folders of (epoch, bucket). One sieve per bucket, ``blocks`` bitmaps of 4 KB,
    has PROBES bits set for every id; sieves are merged by bitwise or, and each epoch writes
    the merged ones, so an epoch reads one sieve table of fixed size instead of the history.
    An id with an unset bit is new; only buckets in which some id has all bits set are
    opened. About ten bits an id keep false alarms near one in a hundred; a fuller sieve
    opens more buckets and changes nothing else.
    """

    spark: SparkSession
    path: str
    buckets: int = 32
    blocks: int = 32
    _last: dict[int, int] = field(default_factory=dict, compare=False)

    def _placed(self, ids: DataFrame) -> DataFrame:
        h = F.xxhash64("record_id", F.lit("history"))
        bits = [F.pmod(F.xxhash64("record_id", F.lit(i)), F.lit(BITMAP_BITS)) for i in range(PROBES)]
        return ids.select(
            "record_id", F.pmod(h, F.lit(self.buckets)).cast("int").alias("bucket"),
            F.pmod(F.shiftright(h, 20), F.lit(self.blocks)).cast("int").alias("block"), F.array(*bits).alias("bits"))

    def _sieve(self, epoch: int) -> DataFrame:
        """(bucket, block, sieve) over all epochs before ``epoch``."""
        stored = earlier_epochs(read_epochs(self.spark, f"{self.path}/sieve", "bucket int, block int, sieve binary"), epoch)
        if epoch not in self._last:
            newest = stored.agg(F.max("epoch")).first()[0]
            self._last[epoch] = -1 if newest is None else newest
        return stored.where(F.col("epoch") == self._last[epoch]).drop("epoch")

    def known(self, ids: DataFrame, epoch: int) -> DataFrame:
        """(record_id): those of ``ids`` (distinct) that an earlier epoch stored."""
        placed = self._placed(ids).join(self._sieve(epoch), ["bucket", "block"])
        suspects = materialize(placed.where(_all_set("sieve", "bits")).select("record_id", "bucket"), "suspects")
        hit = [r.bucket for r in suspects.select("bucket").distinct().collect()]  # at most ``buckets``
        seen = earlier_epochs(read_epochs(self.spark, f"{self.path}/ids", "record_id string, bucket int"), epoch)
        return seen.where(F.col("bucket").isin(hit)).join(suspects.select("record_id").hint("shuffle_hash"), "record_id", "left_semi").select("record_id").distinct()

    def add(self, ids: DataFrame, epoch: int) -> None:
        """Store the new ids of an epoch; running the epoch again replaces them."""
        placed = self._placed(ids)
        keys = placed.select("record_id", "bucket").repartition("bucket")
        keys.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/ids/epoch={epoch}")
        new = placed.select("bucket", "block", F.explode("bits").alias("bit")).groupBy("bucket", "block").agg(
            F.bitmap_construct_agg("bit").alias("sieve"))
        merged = self._sieve(epoch).unionByName(new).groupBy("bucket", "block").agg(F.bitmap_or_agg("sieve").alias("sieve"))
        write_epoch(merged, f"{self.path}/sieve", epoch)


def _all_set(sieve: str, bits: str) -> Column:
    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(sieve, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1

    return F.forall(bits, is_set)
