"""Lodestar: catalog, review and recommendation jobs written as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so executors
# do not need this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
