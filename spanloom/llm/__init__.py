"""Operators for preparing training text; nothing outside this folder imports them."""

import sys

from pyspark import cloudpickle

# functions travel to the executors themselves, so that these need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
