"""tickloom: market-data and portfolio analytics as Spark DataFrame transforms.

Every public operator is a plain ``DataFrame -> DataFrame`` function whose work
runs on executors; see ``README.md`` for the module map.
"""

import sys as _sys

# Grouped-pandas functions (EMA recurrences, stateful alerts, user models) are
# shipped to Python workers with the task: pickle this package by value so
# executors need no copy of it on their path.
try:  # pragma: no cover - depends on the PySpark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass

__all__ = ["session"]
