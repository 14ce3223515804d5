"""benchtrail: build-regression analytics on Spark."""

import sys as _sys

# Functions that run in Python workers (grouped-map and pandas UDF helpers)
# are shipped with their code, so executors need no copy of this package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark without the hook
    pass
