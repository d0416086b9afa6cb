"""Operators for training-data pipelines; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions run by Python workers travel with the query; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
