"""Stored index of the ids of a vector table: hash buckets, and a Bloom filter for each.

Ids lie in folders by bucket (``pmod(xxhash64(id), buckets)``).  Each addition
also appends the Bloom bits of its ids, as sparse rows (bucket, word, bits) of
64-bit words; rows of one word are OR-ed when read, and :meth:`IdIndex.compact`
folds them.  A lookup runs in the JVM: the intake's ids give their bucket and
``hashes`` bit positions, which are joined to the filter words; ids whose bits
are all set may be stored, all others are certainly new.  Only the buckets of
the ids that may be stored are then read, exactly: the semi join is on the
bucket column, so dynamic partition pruning narrows the scan to those folders
when the candidates are few enough to broadcast.

Sizing: ``bits`` per bucket hold about ``bits / 10`` ids at 1 % false positives;
beyond that the filters pass more ids on and only the number of buckets read
grows, never a wrong answer.  Deleted ids leave their bits set for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, remove_path, scratch_path

BUCKETS = 256
BITS = 1 << 20
HASHES = 7
# candidate ids broadcast for the pruned read at most; more are joined without pruning
BROADCAST_IDS = 1_000_000
# where records of one id are ranked, the rank of the stored one (see embed.rank_of); else null
RANK = "struct<day:string,name:string,file:string,line:bigint,doc:int>"


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def bit_positions(key: Column, bits: int = BITS, hashes: int = HASHES) -> Column:
    """The filter's bit positions of an id: ``h1 + i * h2`` modulo ``bits`` (double hashing)."""
    h1 = F.pmod(F.xxhash64(key, F.lit("bloom")), F.lit(bits))
    h2 = F.pmod(F.hash(key, F.lit("bloom")).cast("long") * 2 + 1, F.lit(bits))
    return F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda i: F.pmod(h1 + i.cast("long") * h2, F.lit(bits)))


class IdIndex:
    """Ids in bucket folders below ``path``, and their filters."""

    def __init__(self, spark: SparkSession, path: str, key: str = "gkg_record_id", buckets: int = BUCKETS,
                 bits: int = BITS, hashes: int = HASHES):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.buckets, self.bits, self.hashes = buckets, bits, hashes
        self.ids_path, self.bloom_path = f"{self.path}/ids", f"{self.path}/bloom"

    def _words(self, ids: DataFrame) -> DataFrame:
        """(bucket, word, bits) of the given ids, one row per word."""
        p = F.explode(bit_positions(F.col(self.key), self.bits, self.hashes)).alias("p")
        placed = ids.select(bucket_of(F.col(self.key), self.buckets).alias("bucket"), p)
        return placed.groupBy("bucket", (F.col("p") / 64).cast("int").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(p % 64 AS INT))")).alias("bits"))

    def add(self, ids: DataFrame) -> None:
        """Index the ids of ``ids`` (column ``key``, and ``rank`` if there); nulls are not indexed,
        copies once per call with their least rank."""
        rank = F.col("rank").cast(RANK) if "rank" in ids.columns else F.lit(None).cast(RANK)
        rows = ids.select(self.key, rank.alias("rank")).where(F.col(self.key).isNotNull()).groupBy(self.key).agg(
            F.min("rank").alias("rank"))
        path = scratch_path(self.spark, "new-ids")
        rows.write.parquet(path)  # the caller's rows are evaluated once
        fresh = self.spark.read.parquet(path)
        fresh.withColumn("bucket", bucket_of(F.col(self.key), self.buckets)).write.mode("append").partitionBy(
            "bucket").parquet(self.ids_path)
        self._words(fresh).write.mode("append").parquet(self.bloom_path)
        remove_path(self.spark, path)

    def ids(self) -> DataFrame:
        schema = f"{self.key} string, rank {RANK}, bucket int"
        if not path_exists(self.spark, self.ids_path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.ids_path)

    def words(self) -> DataFrame:
        if not path_exists(self.spark, self.bloom_path):
            return self.spark.createDataFrame([], "bucket int, word int, bits long")
        return self.spark.read.schema("bucket int, word int, bits long").parquet(self.bloom_path)

    def maybe_stored(self, ids: DataFrame) -> DataFrame:
        """(key, bucket) of the distinct asked ids that the filters do not rule out."""
        asked = ids.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        probes = asked.select(self.key, bucket_of(F.col(self.key), self.buckets).alias("bucket"),
                              F.explode(bit_positions(F.col(self.key), self.bits, self.hashes)).alias("p"))
        probes = probes.select(self.key, "bucket", (F.col("p") / 64).cast("int").alias("word"),
                               F.expr("shiftleft(1L, cast(p % 64 AS INT))").alias("bit"))
        met = probes.join(self.words(), ["bucket", "word"]).groupBy(self.key, "bucket", "word", "bit").agg(
            F.bit_or("bits").alias("bits"))
        hit = met.where((F.col("bits").bitwiseAND(F.col("bit"))) != 0)
        return hit.groupBy(self.key, "bucket").agg(F.count(F.lit(1)).alias("n")).where(
            F.col("n") == F.lit(self.hashes)).drop("n")

    def ranks_among(self, ids: DataFrame) -> DataFrame:
        """(key, rank) of the distinct ids of ``ids`` that are indexed, read from their buckets only."""
        maybe = self.maybe_stored(ids)
        n = maybe.count()
        if not n:
            return self.spark.createDataFrame([], f"{self.key} string, rank {RANK}")
        side = F.broadcast(maybe) if n <= BROADCAST_IDS else maybe
        found = self.ids().join(side, ["bucket", self.key], "left_semi")
        return found.groupBy(self.key).agg(F.min("rank").alias("rank"))

    def stored_among(self, ids: DataFrame) -> DataFrame:
        """The distinct ids of ``ids`` that are indexed, read from their buckets only."""
        return self.ranks_among(ids).select(self.key)

    def remove(self, ids: DataFrame) -> None:
        """Take ids out of their bucket folders; their filter bits stay (more ids read, never a wrong answer)."""
        gone = ids.select(self.key).where(F.col(self.key).isNotNull()).distinct().withColumn(
            "bucket", bucket_of(F.col(self.key), self.buckets))
        touched = [r.bucket for r in self.ids().join(gone, ["bucket", self.key], "left_semi").select("bucket").distinct().collect()]
        if not touched:
            return
        staged = scratch_path(self.spark, "ids")
        self.ids().where(F.col("bucket").isin(touched)).join(gone, ["bucket", self.key], "left_anti").write.partitionBy(
            "bucket").parquet(staged)
        kept = self.spark.read.schema(f"{self.key} string, rank {RANK}, bucket int").parquet(staged)
        left = {r.bucket for r in kept.select("bucket").distinct().collect()}
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.ids_path)
        for b in set(touched) - left:
            remove_path(self.spark, f"{self.ids_path}/bucket={b}")
        remove_path(self.spark, staged)

    def compact(self) -> None:
        """Fold the filter rows of each word into one."""
        if not path_exists(self.spark, self.bloom_path):
            return
        staged = scratch_path(self.spark, "bloom")
        self.words().groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits")).write.parquet(staged)
        self.spark.read.parquet(staged).write.mode("overwrite").parquet(self.bloom_path)
        remove_path(self.spark, staged)
