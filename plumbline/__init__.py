"""plumbline: data quality, profiling, drift and modelling operators for Spark DataFrames.

Every operator follows the same split: a *fit* step that aggregates on the
cluster and brings back only per-column statistics, and a *transform* step
that is a row-local projection over frozen, JSON-serialisable parameters.
"""

__version__ = "0.1.0"
