"""Parallel-text mining and corpus analytics on PySpark."""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions by value, so that they needn't have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
