"""Operators for preparing training text: scoring, near copies, filtering, mixing, search.

Functions of this package go to the executors by value, so these need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
