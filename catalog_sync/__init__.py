"""Spark-native catalog sync and catalog analytics.

Every public operator takes DataFrames plus keyword arguments and returns a
DataFrame (or a small tuple of DataFrames); nothing collects data rows to the
driver except one-row statistics that decide a branch.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value when Spark sends them to Python
    workers (the Arrow/pandas functions of the top-k, LSH, distance and export
    pages), so executors need not have the package installed or on their path."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark is a hard dependency
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
