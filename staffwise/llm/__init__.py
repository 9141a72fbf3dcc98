"""Operators for large-scale training-data preparation on Spark."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Executors get the functions they run with the task; the package need not be installed there.
register_pickle_by_value(sys.modules[__name__])
