"""quarry — retrieval, question answering and evaluation on Spark DataFrames.

Every operator takes DataFrames (or Columns) and returns DataFrames (or
Columns); nothing is collected to the driver except query-side matrices whose
size is checked before they are broadcast (see ``operators.retrieve``).

Layout
------
``functions``   Column -> Column helpers (cleaning, ids, tokens, regex, JSON replies)
``sources``     readers, writers and data-quality checks
``operators``   corpus build, scope, retrieval, ranking, answering, checks, evaluation
``plans``       compositions (answer pipeline, evaluation run) and driver-data adapters
``streaming``   Structured Streaming operators (stateful guards, TTL reuse, answer stream)
"""

import sys as _sys

__all__ = ["params"]

# Python tasks (mapInPandas / applyInPandas) must not depend on the package being installed
# on the executors: functions of this package are shipped with the task by value.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
