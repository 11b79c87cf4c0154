"""Rivulet: analytics over metered-service data, on Spark.

Functions that Spark sends to executors travel by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
