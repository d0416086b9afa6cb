"""Cart-event analytics on PySpark: one set of semantics for batch tables and streams."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the query; workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
