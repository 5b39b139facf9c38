"""Exact deduplication by streaming state, with DataFrame functions only.

Digests of normalised texts are streamed through an aggregate whose state lives
in RocksDB and never expires: for each digest the number of rows, the smallest
identifier, and where its content lies.  Every row that hits a known digest is
then compared with the full text of the row that stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .steps import broadcast_if_small, free_name

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Keys that may be broadcast instead of shuffling whole texts to them (about 100 bytes each).
BROADCAST_KEYS = 200_000
# Rows of one group that are compared in one task.
GROUP_ROWS = 2_000


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def stream_state(spark: SparkSession, path: str, schema, bytes_per_trigger: int) -> DataFrame:
    """State per digest (``rows``, ``first``, ``place``) after streaming the digest table at ``path``."""
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # do not set 4 MB of disk aside for each partition's log
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    out, log = scratch_path(spark, "state"), scratch_path(spark, "state-log")
    arrived = session.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_trigger).parquet(path)
    state = arrived.groupBy("digest").agg(
        F.count(F.lit(1)).alias("rows"), F.min("key").alias("first"), F.min_by("place", "key").alias("place")
    )

    def store(changed: DataFrame, batch: int) -> None:
        # the same folder when a batch is repeated after a failure
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    query = (
        state.writeStream.outputMode("update").option("checkpointLocation", log)
        .trigger(availableNow=True).foreachBatch(store).start()
    )
    query.awaitTermination()
    if query.lastProgress is None:  # nothing arrived
        return spark.read.schema(schema).parquet(path).groupBy("digest").agg(
            F.count(F.lit(1)).alias("rows"), F.min("key").alias("first"), F.min("place").alias("place"))
    changes = spark.read.parquet(out)
    last = F.max(F.struct("batch", "rows", "first", "place")).alias("last")
    return changes.groupBy("digest").agg(last).select("digest", "last.rows", "last.first", "last.place")


def _verified(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column],
              bytes_per_trigger: int) -> DataFrame:
    """(key, digest, first, rows) of every row of ``docs``, after full comparison; stored."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("key"), normalised(F.col(text_col)).alias("text"))
    digests = texts.select("key", digest(F.col("text")).alias("digest"), F.input_file_name().alias("place"))
    path = scratch_path(spark, "digests")
    digests.write.parquet(path)
    table = spark.read.parquet(path)
    kept = scratch_path(spark, "kept")
    stream_state(spark, path, table.schema, bytes_per_trigger).write.parquet(kept)
    state = spark.read.parquet(kept)

    groups = state.filter("rows > 1").select("digest", "first", "rows")
    single = state.filter("rows = 1").select(F.col("first").alias("key"), "digest", "first", "rows")

    # full bytes of the rows of groups, each hit beside the text of the row that stays
    met = texts.withColumn("digest", digest(F.col("text"))).join(broadcast_if_small(groups, BROADCAST_KEYS), "digest")
    shares = F.ceil(F.col("rows") / GROUP_ROWS).cast("int")
    keepers = (
        met.filter(F.col("key").eqNullSafe(F.col("first")))
        .groupBy("digest", "rows").agg(F.min("text").alias("whole"))
        .select("digest", "whole", F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"))
    )
    share = F.pmod(F.xxhash64("key"), shares.cast("bigint")).cast("int")
    hits = met.withColumn("share", share).join(keepers, ["digest", "share"])
    same = F.col("text") == F.col("whole")
    compared = scratch_path(spark, "compared")
    hits.select(
        "key", "digest", "first", "rows", same.alias("same"), F.when(~same, F.col("text")).alias("text")
    ).write.parquet(compared)
    hits = spark.read.parquet(compared)

    equal = hits.filter("same").select("key", "digest", "first", "rows")
    if hits.filter("not same").isEmpty():
        return single.unionByName(equal)
    # other texts under one digest: group them by the text itself
    odd = hits.filter("not same")
    by_text = odd.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("own"))
    fewer = by_text.groupBy("digest").agg(F.sum("n").alias("gone"))
    equal = equal.join(fewer, "digest", "left").select(
        "key", "digest", "first", (F.col("rows") - F.coalesce("gone", F.lit(0))).alias("rows"))
    odd = odd.select("key", "digest", "text").join(by_text, ["digest", "text"]).select(
        "key", "digest", F.col("own").alias("first"), F.col("n").alias("rows"))
    return single.unionByName(equal).unionByName(odd)


def group_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha256, bytes_per_trigger: int = 64 << 30) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, digest.

    Texts are equal when identical after :func:`normalised`; null counts as
    empty.  The row with the smallest id stays; a null id stays only if all ids
    of its group are null.  Of repeated rows with that id one is kept.  An empty
    table gives an empty result.  Columns other than id and text are not read.
    """
    rows = _verified(docs, id_col, text_col, digest, bytes_per_trigger)
    is_first = F.col("key").eqNullSafe(F.col("first"))
    # one row stands for all rows of a group that carry its smallest id
    ties = rows.groupBy("digest", "key", "first", "rows").agg(F.count(F.lit(1)).alias("times"))
    return ties.select(
        F.col("key").alias(id_col), F.col("first").alias("keep_id"), F.col("rows").alias("group_size"),
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time"), is_first.alias("is_first"), "digest",
    ).select(id_col, "keep_id", "group_size", (F.col("is_first") & (F.col("time") == 1)).alias("kept"), "digest")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               bytes_per_trigger: int = 64 << 30) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (see :func:`group_copies`)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "groups")
    _verified(docs, id_col, text_col, sha256, bytes_per_trigger).write.parquet(path)
    rows = spark.read.parquet(path)
    is_first = F.col("key").eqNullSafe(F.col("first"))
    names = docs.columns
    # helper columns take names the caller's columns leave free
    digest_name, key_name = free_name(names, "__digest"), free_name(names, "__key")
    gone_key, gone_digest = free_name(names, "__gone_key"), free_name(names, "__gone_digest")
    gone = rows.filter(~is_first).select(F.col("key").alias(gone_key), F.col("digest").alias(gone_digest)).distinct()
    marked = docs.withColumns({
        digest_name: sha256(normalised(F.col(text_col))), key_name: F.col(id_col),
    })
    here = F.col(digest_name).eqNullSafe(gone[gone_digest]) & F.col(key_name).eqNullSafe(gone[gone_key])
    left = marked.join(broadcast_if_small(gone, BROADCAST_KEYS), here, "left_anti")
    again = rows.filter(is_first).groupBy("digest", "key").count().filter("count > 1")
    if not again.isEmpty():  # repeated rows of the smallest id: one of them
        left = left.dropDuplicates([key_name, digest_name])
    return left.select(*[marked[n] for n in names])
