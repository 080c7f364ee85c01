"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are sent with the job, so executors
# need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
