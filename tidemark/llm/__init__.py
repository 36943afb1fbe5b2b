"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Tasks get these functions by value, so executors need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
