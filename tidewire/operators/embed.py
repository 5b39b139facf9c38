"""Texts -> vectors, behind one small embedder interface."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import assemble
from ..functions.text import words
from ..schemas import DEFAULT_DIMENSIONS


class Embedder(Protocol):
    """Adds a vector column of fixed width to a DataFrame of texts."""

    dimensions: int

    def embed(self, df: DataFrame, text: str = "text", vector: str = "vector") -> DataFrame: ...


class HashingEmbedder:
    """Deterministic default: hashed bag of words, scaled to unit length.

    A word's bucket is the first 32 bits of its MD5 modulo the width.  Counting
    and scaling run in the JVM row by row; there is no shuffle and no Python
    worker.  A text without words gives the zero vector.
    """

    def __init__(self, dimensions: int = DEFAULT_DIMENSIONS):
        self.dimensions = dimensions

    def _bucket(self, word: Column) -> Column:
        head = F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint")
        return F.pmod(head, F.lit(self.dimensions)).cast("string")

    def embed(self, df: DataFrame, text: str = "text", vector: str = "vector") -> DataFrame:
        counter = CountVectorizerModel.from_vocabulary(
            [str(i) for i in range(self.dimensions)], inputCol="_buckets", outputCol="_counts"
        )
        scaler = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0)
        buckets = F.transform(words(F.coalesce(F.col(text), F.lit(""))), self._bucket)
        counted = scaler.transform(counter.transform(df.withColumn("_buckets", buckets)))
        return counted.withColumn(vector, vector_to_array("_unit", "float32")).drop(
            "_buckets", "_counts", "_unit"
        )


# Texts per call of a model, and tries of a call before its task fails.
CALL_TEXTS = 500
CALL_TRIES = 5


class ModelEmbedder:
    """Any model: ``load()`` runs once per Python worker and returns a function
    from a list of texts to a list of vectors.

    Texts go to the model ``batch_size`` at a time.  A failing call is tried
    again within the task, up to ``tries`` times in all, waiting ``backoff``
    seconds and twice as long after each failure; then its task fails, which
    Spark retries elsewhere."""

    def __init__(self, load: Callable[[], Callable], dimensions: int, batch_size: int = CALL_TEXTS,
                 tries: int = CALL_TRIES, backoff: float = 1.0):
        if batch_size < 1 or tries < 1:
            raise ValueError("batch_size and tries must be at least 1")
        self.load = load
        self.dimensions = dimensions
        self.batch_size, self.tries, self.backoff = batch_size, tries, backoff

    def embed(self, df: DataFrame, text: str = "text", vector: str = "vector") -> DataFrame:
        load, width = self.load, self.dimensions
        size, tries, backoff = self.batch_size, self.tries, self.backoff

        def call(model, texts: list[str]) -> list[list[float]]:
            for attempt in range(tries):
                try:
                    return [list(map(float, v)) for v in model(texts)]
                except Exception:
                    if attempt == tries - 1:
                        raise
                    time.sleep(backoff * 2**attempt)
            return []

        @F.pandas_udf("array<float>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                texts = batch.fillna("").tolist()
                vectors = [v for at in range(0, len(texts), size) for v in call(model, texts[at : at + size])]
                if len(vectors) != len(texts) or any(len(v) != width for v in vectors):
                    raise ValueError(f"the model's vectors are not {width} wide, or not one per text")
                yield pd.Series(vectors, dtype=object)

        return df.withColumn(vector, run(F.col(text)))


def embed_texts(df: DataFrame, embedder: Embedder, text: str = "text") -> DataFrame:
    """Vectors for all texts; none is left out."""
    return embedder.embed(df, text, "vector")


def with_text(records: DataFrame) -> DataFrame:
    """Add the embedding text, its hash and its word count."""
    return _hashed(records.withColumn("text", assemble.text_of_record()))


def _hashed(texts: DataFrame) -> DataFrame:
    return texts.withColumns(
        {
            "text_hash": assemble.text_hash(F.col("text")),
            "token_count": assemble.token_count(F.col("text")),
        }
    )


def embed_records(records: DataFrame, embedder: Embedder) -> DataFrame:
    """Record columns with text, text_hash, token_count and vector; records of
    trivial text are left out."""
    text = records.withColumn("text", assemble.text_of_record())
    # A plain filter on the text would be pushed below the parsers, which would
    # then all run twice.  A generator keeps it where it is.
    kept = text.select(
        *records.columns,
        F.explode(F.filter(F.array("text"), assemble.not_trivial)).alias("text"),
    )
    return embedder.embed(_hashed(kept), "text", "vector")


def embedding_results(embedded: DataFrame) -> DataFrame:
    """Just what an embedding run hands on: id, vector, hash and word count."""
    return embedded.select(
        "gkg_record_id", F.col("vector").alias("embedding"), "text_hash", "token_count"
    )


def one_per_id(records: DataFrame, *order: Column, key: str = "gkg_record_id") -> DataFrame:
    """The first record of every id in the given order.

    Spark cuts to one row per id before the shuffle as well (WindowGroupLimit),
    so an id with any number of copies sends one row per task.
    """
    place = W.partitionBy(key).orderBy(*order)
    return records.withColumn("_rn", F.row_number().over(place)).where("_rn = 1").drop("_rn")


def first_of_id() -> list[Column]:
    """Of several records with one id the earliest file counts (by name, then by folder), and in it the
    last line; where lines have no number, the document decides."""
    return [
        F.asc_nulls_first("date_partition"), F.element_at(F.split("source_file", "/"), -1).asc(),
        F.asc("source_file"), F.desc_nulls_last("line_number"), F.hash("document_id").asc(),
    ]


def rank_of() -> Column:
    """The order of :func:`first_of_id` as one value that compares alike: the smaller comes first."""
    return F.struct(
        F.coalesce(F.col("date_partition"), F.lit("")).alias("day"),
        F.coalesce(F.element_at(F.split("source_file", "/"), -1), F.lit("")).alias("name"),
        F.coalesce(F.col("source_file"), F.lit("")).alias("file"),
        F.coalesce(-F.col("line_number").cast("long"), F.lit(2**63 - 1)).alias("line"),
        F.hash("document_id").alias("doc"),
    )


def last_per_id(records: DataFrame, *order: str, key: str = "gkg_record_id") -> DataFrame:
    return one_per_id(records, *[F.desc(c) for c in order], key=key)
