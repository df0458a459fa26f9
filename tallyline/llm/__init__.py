"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Tasks carry this package's functions along, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
