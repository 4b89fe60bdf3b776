"""Operators of a training-data pipeline, and the queries that run them."""

import sys

from pyspark import cloudpickle

# Executors get the functions of this package by value: it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
