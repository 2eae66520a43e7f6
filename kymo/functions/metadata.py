"""Metadata cleaning and validation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Human aliases, missing-value tokens, codes and study names.
HUMAN_ALIASES = ("homo", "homo sapiens", "human", "humans", "h. sapiens")
HUMAN = "HOMO_SAPIENS"
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
SEX_CODES = {1: "MALE", 2: "FEMALE"}
REACH_TASKS = {"CO": "center_out_reaching", "RT": "random_target_reaching"}
STUDY_FOLDERS = {"sleep-cassette": "sleep_cassette", "sleep-telemetry": "sleep_telemetry"}


def normalize_species(species: Column) -> Column:
    return F.when(F.lower(F.trim(species)).isin(*HUMAN_ALIASES), HUMAN)


def known_text(text: Column) -> Column:
    """Null for a missing-value token."""
    return F.when(~text.isin(*NA_TOKENS), text)


def days_of_age(age: Column) -> Column:
    return age.try_cast("double")


def required_text(column: Column, name: str) -> Column:
    """Name of the field when it is missing or empty."""
    return F.when(column.isNull() | (F.length(column) == 0), name)


def optional_text(column: Column, name: str) -> Column:
    """Name of the field when it is present but empty."""
    return F.when(F.length(column) == 0, name)


def violations(*checks: Column) -> Column:
    """Comma list of violated fields, empty when the row is valid."""
    return F.concat_ws(",", *checks)


def age_violation(age: Column, name: str = "age") -> Column:
    """Violated when given but not a number, or negative."""
    number = days_of_age(age)
    return F.when(age.isNotNull() & (number.isNull() | (number < 0)), name)


def taxon(species: Column) -> Column:
    """Taxonomic identifiers reduced to ``NCBITaxon_<number>``."""
    short = F.concat(F.lit("NCBITaxon_"), F.substring_index(species, "_", -1))
    return F.when(species.contains("NCBITaxon"), short).otherwise(species)


def age_in_years(text: Column) -> Column:
    """``<n>yr`` as a number, 0 when unreadable, null when absent."""
    number = F.replace(text, F.lit("yr"), F.lit("")).try_cast("int")
    return F.when(text.isNotNull(), F.coalesce(number, F.lit(0)))


def sex_name(code: Column) -> Column:
    """Name of a sex code; null (a violation) for any other code."""
    named = F.lit(None).cast("string")
    for value, name in SEX_CODES.items():
        named = F.when(code == value, name).otherwise(named)
    return named


def cre_line(name: Column) -> Column:
    return F.substring_index(F.replace(name, F.lit("-"), F.lit("_")), "/", 1)


def timestamp_text(micros: Column) -> Column:
    """Seconds always, six digits of microseconds only when there are any."""
    whole = F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd HH:mm:ss")
    part = F.pmod(micros, F.lit(1_000_000))
    return F.when(part == 0, whole).otherwise(
        F.concat(whole, F.lit("."), F.lpad(part.cast("string"), 6, "0"))
    )


def utc_date(local: Column, zone: Column, session_zone: str = "UTC") -> Column:
    """Clock time in its zone as UTC; without a zone, in the session's zone."""
    return F.to_utc_timestamp(local, F.coalesce(zone, F.lit(session_zone)))
