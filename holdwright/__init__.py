"""Portfolio analytics and corpus preparation as Spark DataFrame transforms."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
