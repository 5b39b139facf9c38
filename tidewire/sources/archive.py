"""Landed feed files (zipped or plain) -> numbered raw lines.

A zip cannot be split, so one file is one unit of work, and so is a small plain
file; files are spread over tasks by size.  A larger plain file is read in blocks
of lines by many tasks, cut into compressed pieces that are stored once; its
lines are numbered from the pieces' line counts and its MD5 is taken piece after
piece, so that no value grows with the file.  Only this unpacking runs in Python
workers.
"""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import urls
from ..schemas import RAW_STORED
from ..session import path_exists, shuffles_dropped
from .tables import read_partitions, replace_partitions, small_side

LINES_PER_BATCH = 20_000
BATCH_BYTES = 4 << 20  # and about so many characters in a batch of lines
ROWS_AT_ONCE = 250  # rows of an incoming batch turned into Python values at once
WHOLE_BYTES = 32 << 20  # larger plain files are read in blocks of lines
PIECE_BYTES = 1 << 20
PIECE_CODEC, PIECE_LEVEL = "zstd", 3
READ_BYTES = 1 << 20
# names that Spark's text source would unpack, and zips: always read whole
PACKED = (".zip", ".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".zstd", ".lzo")
BOM = b"\xef\xbb\xbf"

_UNPACKED = pa.schema(
    [
        ("source_file", pa.string()),
        ("line_number", pa.int64()),
        ("value", pa.string()),
        ("error", pa.string()),
        ("n_bytes", pa.int64()),
        ("actual_md5", pa.string()),
    ]
)
_UNPACKED_DDL = (
    "source_file string, line_number bigint, value string, error string, "
    "n_bytes bigint, actual_md5 string"
)


def read_archives(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Content, name and MD5 of landed files."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(paths)
        .select(
            urls.url_filename(F.col("path")).alias("source_file"),
            F.md5("content").alias("actual_md5"),
            "content",
        )
    )


def list_landed(spark: SparkSession, landing: str) -> DataFrame:
    """Path, name and size of all landed files; contents are not read."""
    if not path_exists(spark, landing):
        return spark.createDataFrame([], "path string, source_file string, length bigint")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(landing)
        .select("path", urls.url_filename(F.col("path")).alias("source_file"), "length")
    )


def _lines(name: str, start: int, values: list[str]) -> pa.RecordBatch:
    n = len(values)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * n, pa.string()),
            pa.array(range(start, start + n), pa.int64()),
            pa.array(values, pa.string()),
            pa.nulls(n, pa.string()),
            pa.nulls(n, pa.int64()),
            pa.nulls(n, pa.string()),
        ],
        schema=_UNPACKED,
    )


def _head(name: str, error: str | None, n_bytes: int, md5: str | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name], pa.string()),
            pa.array([0], pa.int64()),
            pa.nulls(1, pa.string()),
            pa.array([error], pa.string()),
            pa.array([n_bytes], pa.int64()),
            pa.array([md5], pa.string()),
        ],
        schema=_UNPACKED,
    )


def _unpack(batches: Iterator[pa.RecordBatch], heads_only: bool = False) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column("source_file").to_pylist()
        sums = batch.column("actual_md5").to_pylist()
        contents = batch.column("content")
        for i, name in enumerate(names):
            raw = pa.BufferReader(contents[i].as_buffer())
            error, n_bytes, number = None, 0, 1
            try:
                if name.endswith(".zip"):
                    archive = zipfile.ZipFile(raw)
                    entries = archive.infolist()
                    if not entries:
                        raise ValueError(f"Empty zip file: {name}")  # fixed value: the reference's message
                    n_bytes = entries[0].file_size
                    stream = archive.open(entries[0])
                else:
                    n_bytes = len(contents[i].as_buffer())
                    stream = raw
                if heads_only:  # read to the end all the same: damage shows there
                    while stream.read(READ_BYTES):
                        pass
                    yield _head(name, None, n_bytes, sums[i])
                    continue
                text = io.TextIOWrapper(stream, encoding="utf-8", errors="replace", newline=None)
                held, size = [], 0
                for line in text:
                    held.append(line[:-1] if line.endswith("\n") else line)
                    size += len(line)
                    if len(held) == LINES_PER_BATCH or size >= BATCH_BYTES:
                        yield _lines(name, number, held)
                        number += len(held)
                        held, size = [], 0
                if held:
                    yield _lines(name, number, held)
            except Exception as e:  # the file fails, the job goes on
                error = str(e) or type(e).__name__
            yield _head(name, error, n_bytes, sums[i])


def archive_lines(archives: DataFrame) -> DataFrame:
    """Lines of the first entry of each zip, or of the file itself.

    Line 0 stands for the file: it carries size, checksum and, when the file
    could not be unpacked, the error.  Lines of a file with an error are void.
    """
    return archives.select("source_file", "actual_md5", "content").mapInArrow(
        _unpack, _UNPACKED_DDL
    )


def archive_heads(archives: DataFrame) -> DataFrame:
    """Only the rows of line 0 of :func:`archive_lines`: every file is read to its end, no line leaves its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _unpack(batches, heads_only=True)

    return archives.select("source_file", "actual_md5", "content").mapInArrow(run, _UNPACKED_DDL)


# ---------------------------------------------------------------- large plain files


def pack(data: bytes) -> bytes:
    return pa.Codec(PIECE_CODEC, PIECE_LEVEL).compress(data, asbytes=True)


def unpack(data: pa.BinaryScalar, n_bytes: int) -> bytes:
    return pa.decompress(data.as_buffer(), n_bytes, codec=PIECE_CODEC, asbytes=True)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of blocks (path, size, block, value), in order -> compressed pieces of whole lines."""
    key, held, n_bytes, number = None, [], 0, 0

    def piece():
        data = b"\n".join(held) + b"\n"
        # a line ends at \n, \r\n or \r
        n = data.count(b"\n") + data.count(b"\r") - data.count(b"\r\n")
        # the text source gives paths as URIs
        row = [unquote(key[0]), *key[1:], number, n, len(data), pack(data)]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=_PIECE_NAMES)

    parts = (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE))
    for part in parts:
        for *at, value in zip(*(column.to_pylist() for column in part.columns)):
            if at != key or n_bytes >= PIECE_BYTES:
                if held:
                    yield piece()
                number = number + 1 if at == key else 0
                key, held, n_bytes = at, [], 0
            held.append(value)
            n_bytes += len(value) + 1
    if held:
        yield piece()


_PIECES = "path string, size bigint, block bigint, number bigint, n_lines bigint, n_bytes bigint, data binary"
_PIECE_NAMES = [c.split()[0] for c in _PIECES.split(", ")]
_PLACE = ["path", "block", "number"]


def _pieces(spark: SparkSession, paths: list[str], scratch: str) -> DataFrame:
    """Pieces of large plain files, stored below ``scratch``, each with what goes before it in its file.

    Spark's text source cuts at line feeds, so the file is its lines and their
    feeds again; whether the last line has one, and whether a byte order mark
    stood before the first, is told by the file's size.
    """
    lines = (
        spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(sorted(set(paths)))
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("value"),
        )
    )
    # small row groups: Spark's reader holds one of them
    lines.mapInArrow(_cut, _PIECES).write.option("parquet.block.size", 16 << 20).parquet(f"{scratch}/pieces")
    stored = spark.read.schema(_PIECES).parquet(f"{scratch}/pieces")
    of_file = W.partitionBy("path")
    before = of_file.orderBy("block", "number")
    places = stored.select(
        *_PLACE,
        (F.sum("n_lines").over(before) - F.col("n_lines")).alias("lines_before"),
        F.lead(F.lit(False), 1, True).over(before).alias("is_last"),
        # bytes of the file beyond its lines with a feed each
        (F.col("size") - F.sum("n_bytes").over(of_file)).alias("extra"),
    )
    places.write.parquet(f"{scratch}/places")  # a row for each PIECE_BYTES
    placed = spark.read.schema(places.schema).parquet(f"{scratch}/places")
    return stored.join(small_side(placed), _PLACE).withColumn("source_file", urls.url_filename(F.col("path")))


def _piece_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, before, extra, n_bytes = (batch.column(i).to_pylist() for i in range(4))
        for i in range(batch.num_rows):
            text = unpack(batch.column(4)[i], n_bytes[i]).decode("utf-8", "replace")
            values = text.replace("\r\n", "\n").replace("\r", "\n")[:-1].split("\n")
            if before[i] == 0 and extra[i] >= 2:
                values[0] = BOM.decode() + values[0]
            for at in range(0, len(values), LINES_PER_BATCH):
                yield _lines(names[i], before[i] + at + 1, values[at : at + LINES_PER_BATCH])


def _piece_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One head per file from its pieces in order."""
    md5 = None
    for batch in batches:
        columns = ("source_file", "size", "extra", "is_last", "n_bytes")
        rows = zip(*(batch.column(c).to_pylist() for c in columns))
        for i, (name, size, extra, is_last, n_bytes) in enumerate(rows):
            if md5 is None:
                md5 = hashlib.md5(BOM if extra >= 2 else b"", usedforsecurity=False)
            data = unpack(batch.column("data")[i], n_bytes)
            # without a feed after the last line the file is a byte shorter than its lines
            md5.update(data[:-1] if is_last and extra in (-1, 2) else data)
            if is_last:
                changed = None if extra in (-1, 0, 2, 3) else f"File changed while it was read: {name}"
                yield _head(name, changed, size, md5.hexdigest())
                md5 = None


def _by_size(files: Iterable[tuple[str, int]]) -> tuple[list[str], list[str]]:
    whole, large = [], []
    for path, length in files:
        (large if length > WHOLE_BYTES and not path.lower().endswith(PACKED) else whole).append(path)
    return whole, large


def _sums(pieces: DataFrame, scratch: str) -> DataFrame:
    """Heads of large files: the compressed pieces of a file pass through one task, one after the other.

    Stored below ``scratch`` at once, so that the shuffled pieces are gone before any line is written.
    """
    spark = pieces.sparkSession
    ordered = pieces.repartition("path").sortWithinPartitions(*_PLACE)
    heads = ordered.select("source_file", "size", "extra", "is_last", "n_bytes", "data").mapInArrow(_piece_sums, _UNPACKED_DDL)
    with shuffles_dropped(spark):
        heads.write.parquet(f"{scratch}/heads")
    return spark.read.schema(_UNPACKED_DDL).parquet(f"{scratch}/heads")


def landed_lines(spark: SparkSession, files: Iterable[tuple[str, int]], scratch: str) -> DataFrame:
    """:func:`archive_lines` of landed files (path, size) of any size.

    ``scratch`` names a folder not used before; it is needed until the rows have been read.
    """
    whole, large = _by_size(files)
    rows = archive_lines(read_archives(spark, whole)) if whole else spark.createDataFrame([], _UNPACKED_DDL)
    if large:
        pieces = _pieces(spark, large, scratch)
        lines = pieces.select("source_file", "lines_before", "extra", "n_bytes", "data").mapInArrow(_piece_lines, _UNPACKED_DDL)
        rows = rows.unionByName(lines).unionByName(_sums(pieces, scratch))
    return rows


def landed_heads(spark: SparkSession, files: Iterable[tuple[str, int]], scratch: str) -> DataFrame:
    """Only the rows of line 0 of :func:`landed_lines`."""
    whole, large = _by_size(files)
    rows = archive_heads(read_archives(spark, whole)) if whole else spark.createDataFrame([], _UNPACKED_DDL)
    if large:
        rows = rows.unionByName(_sums(_pieces(spark, large, scratch), scratch))
    return rows


# ---------------------------------------------------------------- checksums


def checksum_join(unpacked: DataFrame, files: DataFrame) -> DataFrame:
    """One row per fetched file: downloaded, or failed with the reason.

    ``files`` holds file_url and checksum_md5 (null: nothing to verify).  Only
    the one row per file that carries the checksum takes part, never contents.
    """
    wanted = files.select(
        "file_url",
        F.col("checksum_md5").alias("_wanted"),
        urls.url_filename(F.col("file_url")).alias("source_file"),
    )
    heads = unpacked.where(F.col("line_number") == 0)
    mismatch = F.col("_wanted").isNotNull() & (F.col("_wanted") != F.col("actual_md5"))
    message = F.when(
        mismatch,
        # Fixed value: the message reads as the reference's.
        F.concat(
            F.lit("MD5 mismatch for "),
            F.col("file_url"),
            F.lit(": expected "),
            F.col("_wanted"),
            F.lit(", got "),
            F.col("actual_md5"),
        ),
    ).otherwise(F.col("error"))
    return (
        heads.join(wanted, "source_file")
        .withColumn("error_message", message)
        .select(
            "file_url",
            "source_file",
            F.when(F.col("error_message").isNull(), F.lit("downloaded"))
            .otherwise(F.lit("failed"))
            .alias("status"),
            F.when(F.col("error_message").isNull(), F.col("n_bytes")).alias("file_size_bytes"),
            "actual_md5",
            "error_message",
        )
    )


# ---------------------------------------------------------------- raw store


def landing_layout(files: DataFrame, name: str = "source_file") -> DataFrame:
    """Add year and month folders taken from the file name."""
    return files.withColumns(
        {
            "year": urls.landing_year(F.col(name)),
            "month": urls.landing_month(F.col(name)),
        }
    )


RAW_PARTITIONS = ["year", "month", "source_file"]


def write_raw(unpacked: DataFrame, path: str) -> None:
    """Keep unpacked lines, a file per partition; fetching again replaces it."""
    rows = landing_layout(unpacked).select([f.name for f in RAW_STORED.fields])
    replace_partitions(rows, path, RAW_PARTITIONS)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], RAW_STORED)
    return spark.read.schema(RAW_STORED).parquet(path)


def read_raw_of(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """Raw rows of the given stored list of files (source_file and any columns
    to carry).  Only the months these files belong to are listed and read."""
    months = landing_layout(files).select("year", "month").distinct().collect()
    rows = read_partitions(spark, path, RAW_STORED, [r.asDict() for r in months])
    return rows.drop("year", "month").join(small_side(files), "source_file")
