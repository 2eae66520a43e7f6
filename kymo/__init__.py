"""Kymo: recorded time series on PySpark.

Manifest, cleaning, segmentation, interval algebra and reproducible splits of
recordings, every step a DataFrame-to-DataFrame function keyed by recording.
"""

__version__ = "0.1.0"
