"""Response-delay analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions run in tasks travel by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
