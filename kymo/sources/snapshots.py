"""Recordings in committed snapshots: one Parquet table per component, versioned by write.

A write puts all its components below a version's folder that nobody reads, then the list of the
recordings it holds, and last one row that names the version. That row is one small file, moved
into place at once, and is what makes the write visible: a job that dies before it leaves the old
recordings readable and the item unfinished. A later commit replaces the recordings it lists, per
component. Writers need no lock; of two that run side by side the later row counts.

    <root>/_commits/                          version, seq
    <root>/_recordings/version=<v>/           component, dataset_id, recording_id
    <root>/<component>/version=<v>/dataset_id=<d>/recording_id=<r>/
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kymo.plans.lanes import looked_up
from kymo.sources.store import PARTITIONS

COMMITS = "_commits"
RECORDINGS = "_recordings"
_COMMIT = "version string, seq bigint"


def _folder(root: str, name: str, version: str) -> str:
    return f"{root}/{name}/version={version}"


def stage(tables: dict[str, DataFrame], root: str, partitions: Sequence[str] = PARTITIONS) -> str:
    """Write all components of a new version, seen by no reader, and return the version.

    Rebalancing gathers a recording's rows into few files, and still splits a recording that is
    too large for one.
    """
    for component in tables:
        if not component or component[0] in "_." or "/" in component:
            raise ValueError(f"{component!r} cannot name a component")
    version = uuid.uuid4().hex
    for component, df in tables.items():
        rows = df.hint("rebalance", *partitions)
        rows.write.partitionBy(*partitions).parquet(_folder(root, component, version))
    return version


def commit(
    spark: SparkSession,
    root: str,
    version: str,
    components: Sequence[str],
    recordings: DataFrame | None = None,
    partitions: Sequence[str] = PARTITIONS,
) -> None:
    """Make a staged version visible.

    It replaces the recordings it has rows of, per component; with ``recordings`` (the key columns)
    all of these in all components, rows or not, so that a recording that became empty is empty.
    """
    parts = list(partitions)
    names = F.array(*[F.lit(c) for c in components])
    if recordings is not None:
        held = recordings.select(F.explode(names).alias("component"), *_text(parts))
    else:
        # only folders' names are read of these
        tables = [
            spark.read.option("basePath", _folder(root, c, version))
            .schema(", ".join(f"`{p}` string" for p in parts))
            .parquet(_folder(root, c, version))
            .select(F.lit(c).alias("component"), *_text(parts))
            for c in components
        ]
        held = reduce(DataFrame.unionByName, tables)
    held.distinct().write.parquet(_folder(root, RECORDINGS, version))
    last = _commits(spark, root).agg(F.max("seq")).first()[0]
    row = spark.createDataFrame([(version, 0 if last is None else last + 1)], _COMMIT)
    row.coalesce(1).write.mode("append").parquet(f"{root}/{COMMITS}")


def write_recording(
    tables: dict[str, DataFrame],
    root: str,
    recordings: DataFrame | None = None,
    partitions: Sequence[str] = PARTITIONS,
) -> str:
    """Write all component tables as one commit; a retry after any failure is a new version."""
    if not tables:
        raise ValueError("a write needs a component")
    spark = next(iter(tables.values())).sparkSession
    version = stage(tables, root, partitions)
    commit(spark, root, version, list(tables), recordings, partitions)
    return version


def current(spark: SparkSession, root: str, partitions: Sequence[str] = PARTITIONS) -> DataFrame:
    """The version that holds each component's recordings: ``(component, <keys as text>, version)``."""
    keys = ["component", *partitions]
    schema = ", ".join(f"`{k}` string" for k in keys)
    # one row per commit, so their list is short
    seqs = {r.version: r.seq for r in _commits(spark, root).collect()}
    if not seqs:
        return spark.createDataFrame([], f"{schema}, version string")
    held = spark.read.schema(f"{schema}, version string").option("basePath", f"{root}/{RECORDINGS}")
    listed = held.parquet(*[_folder(root, RECORDINGS, v) for v in sorted(seqs)])
    known = F.broadcast(spark.createDataFrame(sorted(seqs.items()), _COMMIT))
    newest = F.max_by("version", F.struct("seq", "version"))
    return listed.join(known, "version").groupBy(*keys).agg(newest.alias("version"))


def committed(spark: SparkSession, root: str, partitions: Sequence[str] = PARTITIONS) -> DataFrame:
    """Keys (as text) of recordings with at least one committed component: what a rerun may skip."""
    return current(spark, root, partitions).select(*partitions).distinct()


def read_component(
    spark: SparkSession, root: str, component: str, schema: str, partitions: Sequence[str] = PARTITIONS
) -> DataFrame:
    """The committed rows of one component, in its declared schema; filters on the keys prune folders.

    Only folders of versions that hold current recordings are listed; rows that a later commit
    replaced are left out. Without a commit the table is empty.
    """
    parts = list(partitions)
    here = current(spark, root, parts).filter(F.col("component") == component)
    sizes = [F.coalesce(F.octet_length(p), F.lit(0)) for p in parts]
    each = reduce(lambda a, b: a + b, sizes, F.lit(64)).cast("bigint")
    versions = here.groupBy("version").agg(F.sum(each).alias("n_bytes")).collect()
    if not versions:
        return spark.createDataFrame([], schema)
    declared = spark.createDataFrame([], schema).schema
    # keys are matched as their folders spell them
    stored = [T.StructField(f.name, T.StringType()) if f.name in parts else f for f in declared]
    table = (
        spark.read.schema(T.StructType([*stored, T.StructField("version", T.StringType())]))
        .option("basePath", f"{root}/{component}")
        .parquet(*sorted(_folder(root, component, r.version) for r in versions))
    )
    known = here.select(*parts, "version", F.lit(True).alias("current_"))
    found = looked_up(table, known, [*parts, "version"], sum(r.n_bytes for r in versions))
    return found.filter("current_").select(*[F.col(f.name).cast(f.dataType) for f in declared])


def superseded(spark: SparkSession, root: str, partitions: Sequence[str] = PARTITIONS) -> DataFrame:
    """Committed versions that hold no current recording; their folders may be removed."""
    used = current(spark, root, partitions).select("version").distinct()
    return _commits(spark, root).join(used, "version", "left_anti")


def _text(parts: Sequence[str]):
    # an empty text and null share a folder
    return [F.nullif(F.col(p).cast("string"), F.lit("")).alias(p) for p in parts]


def _commits(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(_COMMIT).parquet(f"{root}/{COMMITS}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _COMMIT)
