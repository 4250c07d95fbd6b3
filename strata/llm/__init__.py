"""Operators of a training-data pipeline (tokens, secrets, duplicates, mixing)."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors by value, so those need no
# installed copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
