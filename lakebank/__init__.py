"""lakebank: banking lakehouse analytics as PySpark DataFrame and streaming jobs."""

import sys as _sys

# Functions shipped to Python workers (mapInPandas, applyInPandasWithState)
# are pickled by value, so executors need not have this package installed.
try:  # pragma: no cover - depends on the PySpark build
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
