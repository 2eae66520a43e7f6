"""File-arrival form of the incremental run."""
