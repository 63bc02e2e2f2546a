"""Operators of a training-data pipeline, one module each."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so executors need
# the third-party libraries only, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
