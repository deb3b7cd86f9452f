"""Spark-native analytics engine for sequence sets and large result tables."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
