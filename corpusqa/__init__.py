"""corpusqa: extractive question answering data engine on Spark DataFrames.

Every operator is a function DataFrame -> DataFrame built from Spark SQL
expressions, array higher-order functions, windows and grouped aggregation;
Arrow (pandas) functions are used only where noted.
"""

__version__ = "0.1.0"

# Functions of this package that run inside Python workers (Arrow / pandas
# functions) are shipped by value, so executors need no installed copy.
try:  # pragma: no cover - depends on the Spark build
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
