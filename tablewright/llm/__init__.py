"""Operators for preparing training text: duplicates, toxicity, tokens, packing, shards."""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so that executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
