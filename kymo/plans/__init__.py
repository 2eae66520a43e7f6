"""Plan shapes shared by the operators: skew-safe ordered scans, halos, sweeps."""

from kymo.plans.lanes import (
    LANE,
    Cuts,
    assign_lanes,
    attach,
    exact_median,
    measure,
    no_cuts,
    ordered,
    spread_range,
    with_halo,
)
from kymo.plans.sweep import coverage_changes, sweep

__all__ = [
    "LANE",
    "Cuts",
    "assign_lanes",
    "attach",
    "coverage_changes",
    "exact_median",
    "measure",
    "no_cuts",
    "ordered",
    "spread_range",
    "sweep",
    "with_halo",
]
