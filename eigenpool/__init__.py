"""Clustering analytics on Spark for numeric tables pooled from several owners."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, which so need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
