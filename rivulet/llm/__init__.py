"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Its functions travel to the executors with the jobs, so the library need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
