"""streamops: event and stream analytics operators as Spark DataFrame plans.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a pair of
them for routed outputs).  Order-dependent operators take an explicit
arrival column; none relies on the physical order of rows.
"""

import sys as _sys

# Python functions shipped to executors (mapInPandas folds, stateful
# processors) are pickled by value, so executors need not have this package
# on their path.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

__all__ = ["session", "catalog"]
