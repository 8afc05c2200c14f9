"""tamis: corpus preparation and evaluation analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the plan, so executors need no
# copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
