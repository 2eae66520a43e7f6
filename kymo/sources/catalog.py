"""File listings, sidecar files and checksum lists as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kymo.functions import metadata as md
from kymo.functions import paths as ph


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below a folder with its length; contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(F.col("path").alias("key"), "length")
    )


def file_catalog(keys: DataFrame, key: str, prefix: str, out: str = "relative") -> DataFrame:
    """Keys under the prefix with what follows it."""
    return keys.withColumn(out, ph.relative_key(F.col(key), prefix)).filter(
        F.col(out).isNotNull()
    )


def parse_object_url(df: DataFrame, url: str, scheme: str = "s3") -> DataFrame:
    """Scheme, bucket and prefix of a URL; ``is_valid`` marks the expected scheme."""
    u = F.col(url)
    return df.withColumns(
        {
            "scheme": ph.url_scheme(u),
            "bucket": ph.url_bucket(u),
            "prefix": ph.url_prefix(u),
            "is_valid": ph.url_scheme(u) == scheme,
        }
    )


def read_participants(
    spark: SparkSession, path: str, key: str = "participant_id"
) -> DataFrame | None:
    """Participants table as clean text; None when the key column is missing."""
    raw = spark.read.csv(path, sep="\t", header=True, inferSchema=False, quote="")
    if key not in raw.columns:
        return None
    return raw.select(
        key, *[md.known_text(F.col(c)).alias(c) for c in raw.columns if c != key]
    )


def read_json_sidecars(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Sidecar files as ``(stem, json)``."""
    return (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .text(folder, wholetext=True)
        .select(ph.file_stem(F.input_file_name()).alias("stem"), F.col("value").alias("json"))
    )


def attach_sidecar(
    recordings: DataFrame, sidecars: DataFrame, on: Sequence[str], schema: str
) -> DataFrame:
    """Parsed sidecar per recording; ``has_sidecar`` is false where none was found."""
    parsed = sidecars.select(*on, F.from_json("json", schema).alias("sidecar"))
    joined = recordings.join(parsed, list(on), "left")
    return joined.withColumn("has_sidecar", F.col("sidecar").isNotNull())


def parse_checksums(lines: DataFrame, column: str = "value") -> DataFrame:
    """``digest  *name`` lines as a table; blank lines and comments drop out."""
    line = F.trim(F.col(column))
    pattern = r"^(\S+)\s+\*?(.*)$"
    return (
        lines.filter((F.length(line) > 0) & ~line.startswith("#") & line.rlike(r"^\S+\s+\S"))
        .select(
            F.regexp_extract(line, pattern, 2).alias("name"),
            F.lower(F.regexp_extract(line, pattern, 1)).alias("md5"),
        )
    )


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    return parse_checksums(spark.read.text(path))


def verify_checksum(
    files: DataFrame, checksums: DataFrame, on: Sequence[str], actual: Column
) -> DataFrame:
    """Compare computed with listed digests: a match needs no fetch."""
    joined = files.withColumn("actual_", actual).join(checksums, list(on), "left")
    ok = F.coalesce(F.col("actual_") == F.col("md5"), F.lit(False))
    return joined.withColumns(
        {"digest_ok": ok, "action": F.when(ok, "skip").otherwise("fetch")}
    ).drop("actual_", "md5")


def static_manifest(names: DataFrame, name: str, out: str = "session_id") -> DataFrame:
    """Manifest from a list of names; the id is the lower-case stem."""
    trimmed = F.trim(F.col(name))
    return names.filter(F.length(trimmed) > 0).withColumn(
        out, F.lower(F.element_at(F.split(ph.file_name(trimmed), r"\."), 1))
    )
