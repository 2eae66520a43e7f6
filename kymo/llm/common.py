"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are maximal runs of characters other than these.
SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"


_shipped: weakref.WeakSet = weakref.WeakSet()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    context = spark.sparkContext
    if context in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="spark-"), "kymo_llm.zip")
    with zipfile.ZipFile(name, "w") as held:
        held.write(os.path.join(top, "__init__.py"), "kymo/__init__.py")
        for file in sorted(os.listdir(os.path.join(top, "llm"))):
            if file.endswith(".py"):
                held.write(os.path.join(top, "llm", file), f"kymo/llm/{file}")
    context.addPyFile(name)
    _shipped.add(context)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: str, n: int) -> Column:
    """Remainder of the key's checksum; a null key counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(n))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it; one of our own only in a local session."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        place = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(place)
    return place


def written(frame: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and kept when executors go."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/kymo-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def bucketed(frame: DataFrame, key: str) -> DataFrame:
    """Like ``written``, but in buckets of the key, so that grouping by it moves no row again."""
    spark = frame.sparkSession
    name = f"kymo_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark).rstrip('/')}/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frame.write.bucketBy(buckets, key).format("parquet").option("compression", "zstd").option("path", path).saveAsTable(name)
    table = spark.table(name)
    # the files stay, as they do for the others; only the name goes
    spark.sql(f"DROP TABLE {name}")
    return table


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of a text; with ``lower``, A-Z in lower case and nothing else changed."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def rows(batches: Iterator[pa.RecordBatch], size: int = 512) -> Iterator[tuple]:
    """The batches' rows; so many at a time become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, size).columns), strict=True)


def batched(schema: pa.Schema, records: Iterator[tuple], size: int = 1000, weight: int = 1 << 24):
    """Record batches of bounded rows and bytes."""
    held: list[tuple] = []
    load = 0
    for record in records:
        held.append(record)
        load += sum(len(x) for x in record if isinstance(x, str | bytes))
        if len(held) >= size or load >= weight:
            yield _batch(schema, held)
            held, load = [], 0
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, held: list[tuple]) -> pa.RecordBatch:
    columns = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))
