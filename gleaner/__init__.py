"""Search and retrieval analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Task functions travel with their job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
