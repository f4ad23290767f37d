"""Query-log mining and schema retrieval as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Batch functions travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
