"""Tenure analytics on Spark: who was where, from when to when, at what cost, with what result."""

import sys

from pyspark import cloudpickle

# The helpers that run inside Python workers travel with the job, so executors need no copy of
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
