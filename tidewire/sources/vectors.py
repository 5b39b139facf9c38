"""The vector table: Parquet, one folder per month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.embed import last_per_id
from ..operators.retrieval import sign_bits
from ..operators.search import finite
from ..schemas import DEFAULT_DIMENSIONS, VECTOR_COLUMNS, VECTOR_STORED
from ..session import path_exists, remove_path, scratch_path
from .id_index import IdIndex
from .tables import partition_path

TABLE_NAME = "gkg_embeddings"
REJECTED = "rejected"  # folder of rows whose vector cannot be searched
VECTOR_NAMES = [f.name for f in VECTOR_COLUMNS]


# ---------------------------------------------------------------- shaping


def country_set(locations: Column) -> Column:
    """Distinct non-empty country codes, sorted."""
    codes = F.transform(locations, lambda x: x["country_code"])
    return F.array_sort(F.array_distinct(F.filter(codes, lambda x: x != "")))


# How much of a record's lists is stored; the embedding text takes no more than this either.
KEPT = {"themes": 20, "persons": 10, "organizations": 10, "locations": 10}


def cut_lists(records: DataFrame) -> DataFrame:
    """Records with their lists cut to what embedding and the vector table use of them, before rows
    are copied, shuffled and sorted."""
    return records.withColumns({c: F.slice(c, 1, n) for c, n in KEPT.items()})


def vec_row_shape(records: DataFrame) -> DataFrame:
    """Record with text_hash and vector -> row of the vector table."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    def head(name: str) -> Column:
        return F.slice(F.coalesce(F.col(name), F.array().cast("array<string>")), 1, KEPT[name])

    top_locations = F.slice("locations", 1, KEPT["locations"])
    names = F.filter(F.transform(top_locations, lambda x: x["full_name"]), lambda x: x != "")
    empty = F.array().cast("array<string>")
    return records.select(
        "gkg_record_id",
        F.substring(text("date_str"), 1, 8).alias("date"),
        text("date_str").alias("timestamp"),
        head("themes").alias("themes"),
        head("persons").alias("persons"),
        head("organizations").alias("organizations"),
        F.coalesce(names, empty).alias("locations"),
        F.coalesce(country_set(top_locations), empty).alias("countries"),
        F.coalesce(F.col("tone.tone"), F.lit(0.0)).cast("float").alias("tone"),
        text("source_common_name").alias("source"),
        text("document_id").alias("source_url"),
        "text_hash",
        "vector",
    )


def join_embed_records(embeddings: DataFrame, records: DataFrame, *order: str) -> DataFrame:
    """Embeddings (id, embedding, text_hash) with the last record of their id.

    ``order`` names the columns that say which record of an id is the last.
    Embeddings without a record are dropped, repeated embeddings all kept.
    """
    last = last_per_id(records, *order)
    taken = [c for c in last.columns if c not in ("text_hash", "vector")]
    return embeddings.select(
        "gkg_record_id", F.col("embedding").alias("vector"), "text_hash"
    ).join(last.select(taken), "gkg_record_id")


def folder_month(date: Column) -> Column:
    """Folder of a row: its month, or ``unknown`` where the date names none.

    Only digits make a folder, so that damaged dates cannot make many.
    """
    month = F.substring(date, 1, 6)
    return F.when(month.rlike("^[0-9]{6}$"), month).otherwise(F.lit("unknown"))


# ---------------------------------------------------------------- ids


def stored_among(ids: DataFrame, store, key: str = "gkg_record_id") -> DataFrame:
    """The distinct ids of ``ids`` that are stored.

    ``store`` is a :class:`VectorTable` or a DataFrame.  A table answers from its id
    index (filters first, then only the buckets of ids that may be stored).  A
    DataFrame is reduced by the asked ids, not the other way round: for a small
    intake Spark broadcasts these (by its own size check) and never shuffles the
    store; for a large one both sides shuffle ids only.
    """
    if isinstance(store, VectorTable) and key == store.index.key:
        return store.stored_among(ids)
    if isinstance(store, VectorTable):
        store = store.read()
    wanted = ids.select(key).distinct()
    return store.select(key).join(wanted, key, "left_semi").distinct()


def existing_ids(ids: DataFrame, store, key: str = "gkg_record_id") -> DataFrame:
    """Rows of ``ids`` whose id is stored; copies are kept."""
    return ids.join(stored_among(ids, store, key), key, "left_semi")


def new_records(records: DataFrame, store, key: str = "gkg_record_id") -> DataFrame:
    """Rows whose id is not stored yet."""
    return records.join(stored_among(records, store, key), key, "left_anti")


# ---------------------------------------------------------------- statistics


def vec_count(store: DataFrame) -> DataFrame:
    return store.agg(F.count(F.lit(1)).alias("total_records"))


def vec_date_range(store: DataFrame) -> DataFrame:
    date = F.nullif(F.col("date"), F.lit(""))
    return store.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def vec_stats(store: DataFrame, location: str = "", table_name: str = TABLE_NAME) -> DataFrame:
    date = F.nullif(F.col("date"), F.lit(""))
    return store.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
    ).withColumns({"db_path": F.lit(location), "table_name": F.lit(table_name)})


# ---------------------------------------------------------------- table


CODES = ("gkg_record_id string, date string, countries array<string>, themes array<string>, bits array<bigint>, "
         "year_month string")


class VectorTable:
    """Create, append, read and delete at a path."""

    def __init__(self, spark: SparkSession, path: str, dimensions: int = DEFAULT_DIMENSIONS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.dimensions = dimensions
        # a hidden folder: Spark's readers of the table do not list it
        self.index = IdIndex(spark, f"{self.path}/_ids")

    def stored_among(self, ids: DataFrame) -> DataFrame:
        """Distinct ids of ``ids`` that the table holds (rejected rows aside), from the id index.

        A table written before it had an index gets one first, from all its ids.
        """
        self._indexed()
        return self.index.stored_among(ids)

    def _indexed(self) -> None:
        if not path_exists(self.spark, self.index.ids_path) and path_exists(self.spark, self.path):
            self.index.add(self.read().select(self.index.key))

    def read(self) -> DataFrame:
        """All rows; the declared schema keeps ``year_month`` a string."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], VECTOR_STORED)
        stored = self.spark.read.schema(VECTOR_STORED).parquet(self.path)
        return self._without_deleted(stored.where(F.col("year_month") != REJECTED))

    def scan(self, *columns: str) -> DataFrame:
        return self.read().select(*columns)

    def rejected(self) -> DataFrame:
        """Rows refused because their vector is null or not finite."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], VECTOR_STORED)
        stored = self.spark.read.schema(VECTOR_STORED).parquet(self.path)
        return stored.where(F.col("year_month") == REJECTED)

    def _checked(self, rows: DataFrame) -> DataFrame:
        """Stored form.  A vector of another width fails the write; rows whose vector is null or
        holds a null, NaN or infinite number go to the folder of rejected rows."""
        fits = F.col("vector").isNull() | (F.size("vector") == self.dimensions)
        vector = F.when(fits, F.col("vector").cast("array<float>")).otherwise(
            F.raise_error(F.lit(f"vector is not {self.dimensions} wide"))
        )
        shaped = rows.select(*VECTOR_NAMES).withColumn("vector", vector)
        month = F.when(finite(F.col("vector")), folder_month(F.col("date"))).otherwise(REJECTED)
        return shaped.withColumn("year_month", month)

    def append(self, rows: DataFrame, ranks: DataFrame | None = None) -> None:
        """Add rows, and their ids to the index with their ``ranks`` (key, rank) if given.

        The rows are evaluated once (staged in the shared folder)."""
        self._indexed()
        self._coded()
        staged = scratch_path(self.spark, "append")
        self._checked(rows).write.parquet(staged)
        ready = self.spark.read.schema(VECTOR_STORED).parquet(staged)
        if path_exists(self.spark, self.deleted_path):
            log = self.spark.read.schema("gkg_record_id string").parquet(self.deleted_path)
            if ready.select("gkg_record_id").join(log, "gkg_record_id", "left_semi").limit(1).count():
                self.compact()  # an id deleted before comes back: the old row must go for good first
        ready.write.mode("append").partitionBy("year_month").parquet(self.path)
        self._write_codes(ready.where(F.col("year_month") != REJECTED))
        ids = ready.where(F.col("year_month") != REJECTED).select(self.index.key)
        self.index.add(ids if ranks is None else ids.join(ranks.select(self.index.key, "rank"), self.index.key, "left"))
        remove_path(self.spark, staged)

    @property
    def codes_path(self) -> str:
        return f"{self.path}/_codes"

    def codes(self) -> DataFrame:
        """Stored sign codes of all usable rows: id, date, countries, themes, ``bits`` (``sign_bits``)
        and month, without the vector: what a first stage reads.  A table written before it had codes
        gets them first."""
        self._coded()
        if not path_exists(self.spark, self.codes_path):
            return self.spark.createDataFrame([], CODES)
        return self._without_deleted(self.spark.read.schema(CODES).parquet(self.codes_path))

    def _coded(self) -> None:
        if not path_exists(self.spark, self.codes_path) and path_exists(self.spark, self.path):
            self._write_codes(self.read())

    def _write_codes(self, rows: DataFrame) -> None:
        usable = rows.where(finite(F.col("vector")))
        usable.select("gkg_record_id", "date", "countries", "themes", sign_bits(F.col("vector"), self.dimensions).alias("bits"),
                      "year_month").write.mode("append").partitionBy("year_month").parquet(self.codes_path)

    def ranks_among(self, ids: DataFrame) -> DataFrame:
        """(id, rank) of the distinct ids of ``ids`` that the table holds; rank null where unknown."""
        self._indexed()
        return self.index.ranks_among(ids)

    def add_records(self, embeddings: DataFrame, records: DataFrame, *order: str) -> None:
        rows = vec_row_shape(join_embed_records(embeddings, records, *order))
        by_month = rows.withColumn("_month", folder_month(F.col("date"))).hint("rebalance", "_month")
        self.append(by_month)

    @property
    def deleted_path(self) -> str:
        return f"{self.path}/_deleted"

    def _without_deleted(self, rows: DataFrame) -> DataFrame:
        """Rows whose id is not in the log of deletions; the log is small, so Spark broadcasts it by its size."""
        if not path_exists(self.spark, self.deleted_path):
            return rows
        log = self.spark.read.schema("gkg_record_id string").parquet(self.deleted_path)
        return rows.join(log, "gkg_record_id", "left_anti")

    def delete_by_ids(self, ids: DataFrame, key: str = "gkg_record_id") -> int:
        """Remove rows by id and return how many there were.

        No vector is written: the ids that are there go to a log that readers
        subtract (and out of the id index); :meth:`compact` applies the log.
        """
        # the ids may be read from this very table: keep a copy before it changes
        asked = scratch_path(self.spark, "delete-ids")
        ids.select(key).distinct().write.parquet(asked)
        wanted = self.spark.read.parquet(asked)
        there = self.read().select(key).join(wanted, key, "left_semi")
        found = scratch_path(self.spark, "deleted")
        there.groupBy(key).agg(F.count(F.lit(1)).alias("n")).write.parquet(found)
        hits = self.spark.read.parquet(found)
        n = hits.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        if n:
            hits.select(key).write.mode("append").parquet(self.deleted_path)
            self.index.remove(hits.select(key))
        remove_path(self.spark, found)
        remove_path(self.spark, asked)
        return int(n)

    def compact(self, key: str = "gkg_record_id") -> int:
        """Apply the log of deletions: rewrite only the months (of rows and codes) that hold a deleted id,
        remove months left empty, then the log.  Returns the number of rows removed."""
        if not path_exists(self.spark, self.deleted_path):
            return 0
        wanted = self.spark.read.schema(f"{key} string").parquet(self.deleted_path).distinct()
        stored = self.spark.read.schema(VECTOR_STORED).parquet(self.path).where(F.col("year_month") != REJECTED)
        hit = {
            r["year_month"]: r["n"]
            for r in stored.select(key, "year_month")
            .join(wanted, key, "left_semi")
            .groupBy("year_month")
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()  # one row per month
        }
        for path, schema in ((self.path, VECTOR_STORED), (self.codes_path, CODES)):
            if not hit or not path_exists(self.spark, path):
                continue
            staged = scratch_path(self.spark, "compact")
            rows = self.spark.read.schema(schema).parquet(path)
            rows.where(F.col("year_month").isin(list(hit))).join(wanted, key, "left_anti").write.partitionBy(
                "year_month").parquet(staged)
            rest = self.spark.read.schema(schema).parquet(staged)
            left = {r["year_month"] for r in rest.select("year_month").distinct().collect()}
            columns = [f.name for f in rest.schema.fields]
            rest.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "year_month").parquet(path)
            for month in set(hit) - left:
                remove_path(self.spark, partition_path(self.spark, path, year_month=month))
            remove_path(self.spark, staged)
        remove_path(self.spark, self.deleted_path)
        return sum(hit.values())
