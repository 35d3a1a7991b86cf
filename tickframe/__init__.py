"""tickframe: entity time-series analytics as lazy Spark DataFrame operators.

Every public operator takes and returns a ``DataFrame`` and performs no
action; callers decide when to execute, cache or write.
"""

import sys as _sys

try:  # ship our own functions to Python workers by value, so the package
    # does not need to be installed on executors for pandas UDFs to run
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

__all__ = ["__version__"]
__version__ = "0.1.0"
