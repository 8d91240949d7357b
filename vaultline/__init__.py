"""Bank history loading and fraud reporting as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel to the executors whole, so nothing has to be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
