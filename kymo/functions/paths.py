"""Keys, URLs and entity file names as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entities of a file name in order, accepted extensions and the
# folder names that say which kind of data a file holds.
ENTITIES = {
    "subject": "sub",
    "session": "ses",
    "task": "task",
    "acquisition": "acq",
    "run": "run",
    "description": "desc",
}
EEG_EXTENSIONS = (".edf", ".vhdr", ".set", ".bdf")
IEEG_EXTENSIONS = (".edf", ".vhdr", ".set", ".bdf", ".nwb")
TOKEN = "^([a-z]+)-[^_]+$"


def relative_key(key: Column, prefix: str) -> Column:
    """What follows the prefix; null for folders, foreign keys and an empty rest."""
    rest = F.substring(key, F.lit(len(prefix) + 1), F.length(key))
    kept = key.startswith(prefix) & ~key.endswith("/") & (F.length(rest) > 0)
    return F.when(kept, rest)


def strip_prefix_of(prefix: str, strip: str | None = None) -> str:
    """The part of the prefix that local paths leave out, with one closing slash."""
    if strip is None:
        strip = prefix if "/" not in prefix else prefix.split("/")[0]
    return strip.rstrip("/") + "/"


def local_path(key: Column, prefix: str, strip: str | None = None) -> Column:
    """Local path of a key; keys outside the stripped prefix stay whole."""
    cut = strip_prefix_of(prefix, strip)
    rest = F.substring(key, F.lit(len(cut) + 1), F.length(key))
    return F.when(key.startswith(cut), rest).otherwise(key)


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))


def url_bucket(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^:]+://([^/?#]*)", 1)


def url_prefix(url: Column) -> Column:
    return F.ltrim(F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1), F.lit("/"))


def parent_dir(path: Column) -> Column:
    """Folder part of a path, ``.`` for a bare name."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(".")


def recording_url(root: str, dataset: str, path: Column, recording_id: Column) -> Column:
    return F.concat(F.lit(f"{root}/{dataset}/"), parent_dir(path), F.lit("/"), recording_id)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(path: Column) -> Column:
    """Name without its last extension."""
    return F.regexp_replace(file_name(path), r"(.)\.[^.]*$", "$1")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r".(\.[^.]+)$", 1))


def datatype(path: Column) -> Column:
    """Name of the folder a file lies in."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(path.contains("/"), folder).otherwise("")


def entity(path: Column, short: str) -> Column:
    """Value of one entity in the file name, null when absent."""
    found = F.regexp_extract(file_name(path), f"(?:^|_){short}-([^_.]+)", 1)
    return F.nullif(found, F.lit(""))


def recording_id(path: Column) -> Column:
    """Entities in their fixed order, absent ones left out."""
    parts = [F.concat(F.lit(f"{s}-"), entity(path, s)) for s in ENTITIES.values()]
    return F.concat_ws("_", *parts)


def group_key(ident: Column, fixed: Sequence[str] | None = None) -> Column:
    """Tokens of an id that name its group, in their own order.

    By default every well-formed token but the run; otherwise the listed entities,
    by long or short name.
    """
    names = {**ENTITIES, **{s: s for s in ENTITIES.values()}}
    if fixed is not None:
        unknown = [e for e in fixed if e.lower() not in names]
        if unknown:
            raise ValueError(f"unsupported entities {unknown}, expected {sorted(names)}")
    wanted = None if fixed is None else [names[e.lower()] for e in fixed]

    def keep(token: Column) -> Column:
        short = F.regexp_extract(token, TOKEN, 1)
        chosen = short != "run" if wanted is None else short.isin(wanted)
        return token.rlike(TOKEN) & chosen

    return F.array_join(F.filter(F.split(ident, "_"), keep), "_")


def encode_recording(subject: Column, session: Column) -> Column:
    """``sub_<n>_trial<3 digits>``, null outside the valid range."""
    valid = (subject >= 0) & (session >= 0) & (session <= 999)
    return F.when(valid, F.format_string("sub_%d_trial%03d", subject, session))


def decode_recording(ident: Column, part: int) -> Column:
    """Subject (part 1) or session (part 2) of an encoded id, null if malformed."""
    found = F.regexp_extract(ident, r"^sub_(\d+)_trial(\d{3})$", part)
    return F.nullif(found, F.lit("")).cast("bigint")


def namespaced(ident: Column, *owners: Column) -> Column:
    """Prefix an id with its owners so that it is unique across recordings."""
    return F.concat_ws("/", *owners, ident)
