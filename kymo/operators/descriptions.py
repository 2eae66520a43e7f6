"""Typed metadata rows with the list of violated fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymo import __version__
from kymo.functions import metadata as md

RESERVED = ("engine_version", "format_version")
FORMAT_VERSION = "1"
DATASET_FIELDS = ("id", "origin_version", "derived_version", "source", "description")


def _extras(df: DataFrame, known: Sequence[str]) -> Column:
    """Unknown fields as a text map."""
    extra = [c for c in df.columns if c not in known]
    if not extra:
        return F.create_map().cast("map<string,string>")
    pairs = [x for c in extra for x in (F.lit(c), F.col(c).cast("string"))]
    return F.create_map(*pairs)


def describe_dataset(df: DataFrame) -> DataFrame:
    """Five required texts; version fields are set here and may not be supplied."""
    taken = [c for c in RESERVED if c in df.columns]
    if taken:
        raise ValueError(f"{taken} cannot be set manually")
    checks = [md.required_text(F.col(c), c) for c in DATASET_FIELDS]
    return df.select(
        *DATASET_FIELDS,
        F.lit(__version__).alias(RESERVED[0]),
        F.lit(FORMAT_VERSION).alias(RESERVED[1]),
        _extras(df, DATASET_FIELDS).alias("extras"),
        md.violations(*checks).alias("violations"),
    )


def describe_subject(df: DataFrame) -> DataFrame:
    known = ("id", "species", "age", "sex")
    return df.select(
        "id",
        "species",
        md.days_of_age(F.col("age")).alias("age"),
        "sex",
        _extras(df, known).alias("extras"),
        md.violations(
            md.required_text(F.col("id"), "id"),
            md.optional_text(F.col("species"), "species"),
            md.optional_text(F.col("sex"), "sex"),
            md.age_violation(F.col("age")),
        ).alias("violations"),
    )


def describe_session(df: DataFrame) -> DataFrame:
    """``recording_date`` is text; null is allowed, unreadable is a violation."""
    date = F.try_to_timestamp(F.col("recording_date"))
    unreadable = F.when(F.col("recording_date").isNotNull() & date.isNull(), "recording_date")
    return df.select(
        "id",
        date.alias("recording_date"),
        _extras(df, ("id", "recording_date")).alias("extras"),
        md.violations(md.required_text(F.col("id"), "id"), unreadable).alias("violations"),
    )


def describe_device(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        "recording_tech",
        _extras(df, ("id", "recording_tech")).alias("extras"),
        md.violations(
            md.required_text(F.col("id"), "id"),
            md.optional_text(F.col("recording_tech"), "recording_tech"),
        ).alias("violations"),
    )


def subject_from_archive(df: DataFrame, ident: str, species: str) -> DataFrame:
    return df.withColumns({ident: F.lower(ident), species: md.taxon(F.col(species))})


def require_valid(df: DataFrame) -> DataFrame:
    """Strict form: the first violating row raises when it is read."""
    message = F.concat(F.lit("invalid fields: "), F.col("violations"))
    checked = F.when(F.col("violations") != "", F.raise_error(message)).otherwise(
        F.col("violations")
    )
    return df.withColumn("violations", checked)
