"""Operators for training data. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Task functions travel with their jobs, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
