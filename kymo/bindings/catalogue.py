"""All bindings, and the flagship query."""

from kymo.bindings import (  # noqa: F401
    flagship,
    intervals,
    manifest,
    reading,
    series,
    splits,
    trials,
    units,
)
from kymo.bindings.registry import ORACLES, QUERIES

FLAGSHIP = "segment_fold_summary"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
