"""Running a manifest: skip finished work, run user code per item, report."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DONE, FAILED = "DONE", "FAILED"
LEDGER_SCHEMA = "item_id string, status string, error string"


def incremental_skip(
    manifest: DataFrame, done: DataFrame, on: Sequence[str], reprocess: bool = False
) -> DataFrame:
    """Items without output yet; all of them when reprocessing."""
    if reprocess:
        return manifest
    return manifest.join(done.select(*on), list(on), "left_anti")


def run_manifest(
    manifest: DataFrame,
    item: str,
    fetch: Callable[[dict], object],
    process: Callable[[dict, object], None] | None = None,
    download_only: bool = False,
    tasks: int | None = None,
    single: str | None = None,
) -> DataFrame:
    """Run user code for every item; a failing item is marked and the others go on.

    Items are spread by a shuffle, since one item may take long; each task streams
    its items and reports one ledger row per item.
    """
    if single is not None:
        manifest = manifest.filter(F.col(item).cast("string") == single)
    elif tasks:
        manifest = manifest.repartition(tasks, item)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for record in batch.to_dict("records"):
                status, error = DONE, None
                try:
                    fetched = fetch(record)
                    if process is not None and not download_only:
                        process(record, fetched)
                except Exception as problem:  # the item's own failure
                    status, error = FAILED, f"{type(problem).__name__}: {problem}"
                rows.append((str(record[item]), status, error))
            yield pd.DataFrame(rows, columns=["item_id", "status", "error"])

    return manifest.mapInPandas(run, LEDGER_SCHEMA)


def run_ledger(ledger: DataFrame, status: str = "status") -> DataFrame:
    """Items per status, and whether the whole run succeeded."""
    counts = ledger.groupBy(status).agg(F.count(F.lit(1)).alias("n_items"))
    whole = counts.agg(F.bool_and(F.col(status) == DONE).alias("all_done"))
    return counts.crossJoin(F.broadcast(whole))


def not_done(ledger: DataFrame, item: str = "item_id", status: str = "status") -> DataFrame:
    """Items that did not finish, in id order."""
    return ledger.filter(F.col(status) != DONE).orderBy(item)
