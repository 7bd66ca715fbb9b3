"""Operators of a training-data pipeline. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors whole, so this package needs no installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
