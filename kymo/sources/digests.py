"""File digests by byte ranges: a data source whose partitions are parts of files.

A task streams its ranges in small pieces, so a file may be larger than any memory. The digest of
a whole file needs its bytes in order and keeps one task per file; a multi-part digest (the MD5 of
the parts' MD5s, and their number) spreads a file over as many tasks as it has parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from kymo.sources.catalog import verify_checksum

PART_BYTES = 64 << 20
# A task takes ranges up to so many bytes; opening a file counts as some more.
TASK_BYTES = 512 << 20
OPEN_BYTES = 4 << 20
READ_BYTES = 1 << 20

FORMAT = "kymo_file_digests"
SCHEMA = "key string, name string, length bigint, n_parts bigint, part bigint, md5 string"


def _source() -> type[DataSource]:
    """The source's class, made here so that it travels whole: executors need not hold this package."""
    schema, task_bytes, open_bytes, read_bytes = SCHEMA, TASK_BYTES, OPEN_BYTES, READ_BYTES
    source_name = FORMAT

    class Ranges(InputPartition):
        def __init__(self, ranges):
            # (key, name, length, parts, part, start, end) each
            self.ranges = ranges

    class RangeReader(DataSourceReader):
        def __init__(self, options):
            self.folder = options["path"]
            self.part_bytes = int(options.get("partBytes", "0"))

        def partitions(self):
            from pyarrow.fs import FileSelector, FileSystem, FileType

            files, root = FileSystem.from_uri(self.folder)
            root = root.rstrip("/")
            found, held, weight = [], [], 0
            for info in files.get_file_info(FileSelector(root, recursive=True)):
                name = info.path[len(root) + 1 :]
                hidden = any(step[:1] in ("_", ".") for step in name.split("/"))
                if info.type != FileType.File or hidden:
                    continue
                size = self.part_bytes or max(info.size, 1)
                n_parts = max(-(-info.size // size), 1)
                for part in range(n_parts):
                    start, end = part * size, min((part + 1) * size, info.size)
                    cost = end - start + (0 if part else open_bytes)
                    if held and weight + cost > task_bytes:
                        found.append(Ranges(held))
                        held, weight = [], 0
                    held.append((info.path, name, info.size, n_parts, part, start, end))
                    weight += cost
            return [*found, Ranges(held)]

        def read(self, partition):
            import hashlib

            from pyarrow.fs import FileSystem

            files, _ = FileSystem.from_uri(self.folder)
            for key, name, length, n_parts, part, start, end in partition.ranges:
                digest, left = hashlib.md5(usedforsecurity=False), end - start
                with files.open_input_file(key) as stream:
                    stream.seek(start)
                    while left:
                        piece = stream.read(min(left, read_bytes))
                        if not piece:
                            raise OSError(f"{key} ended {left} bytes early; it was changed while read")
                        digest.update(piece)
                        left -= len(piece)
                yield key, name, length, n_parts, part, digest.hexdigest()

    class FileDigests(DataSource):
        @classmethod
        def name(cls):
            return source_name

        def schema(self):
            return schema

        def reader(self, schema):
            return RangeReader(self.options)

    return FileDigests


def part_digests(spark: SparkSession, folder: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """MD5 of every part of every file below a folder, one row per part.

    ``folder`` is a path or URI of any file system that pyarrow opens. Names starting with ``_`` or
    ``.`` are left out, as Spark's own readers do. An empty file has one empty part, and a file is
    one part where ``part_bytes`` is 0. The driver lists the folder, as it does for Parquet.
    """
    if part_bytes < 0:
        raise ValueError("part_bytes must not be negative")
    spark.dataSource.register(_source())
    return spark.read.format(FORMAT).option("partBytes", part_bytes).load(folder)


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """MD5 of every whole file as ``(key, name, length, md5)``, ``name`` relative to the folder."""
    return part_digests(spark, folder, 0).select("key", "name", "length", "md5")


def multipart_digests(spark: SparkSession, folder: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Digest of digests per file, ``<md5>-<parts>``, as object stores list it for parts of one size.

    What is gathered per file is its parts' digests, 32 characters for ``part_bytes``.
    """
    if part_bytes <= 0:
        raise ValueError("a multi-part digest needs a part size")
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("part", "md5"))), lambda p: p["md5"]), ""
    )
    return (
        part_digests(spark, folder, part_bytes)
        .groupBy("key", "name", "length", "n_parts")
        .agg(joined.alias("digests_"))
        .select(
            "key",
            "name",
            "length",
            F.concat(F.md5(F.unhex("digests_")), F.lit("-"), F.col("n_parts").cast("string")).alias("etag"),
        )
    )


def verify_files(
    spark: SparkSession, folder: str, checksums: DataFrame, on: Sequence[str] = ("name",), part_bytes: int = 0
) -> DataFrame:
    """Files below a folder against their listed digests (column ``md5``): a match needs no fetch.

    With ``part_bytes`` the list holds multi-part digests. A file that is not listed is to be fetched.
    """
    if part_bytes:
        return verify_checksum(multipart_digests(spark, folder, part_bytes), checksums, on, F.col("etag"))
    whole = file_digests(spark, folder).withColumnRenamed("md5", "whole_")
    return verify_checksum(whole, checksums, on, F.col("whole_")).withColumnRenamed("whole_", "actual")
