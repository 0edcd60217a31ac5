"""Spark DataFrame operators for tabular regression, ordered series, pattern mining and classification."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel to the executors as code, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
