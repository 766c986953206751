"""pixelchange: per-pixel change detection and classification of gridded time series on Spark."""

__version__ = "0.1.0"
