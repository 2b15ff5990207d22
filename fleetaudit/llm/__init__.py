"""Operators for preparing training text: scoring, tokenizing, formatting, deduplication, mixing and search.

Functions that run inside tasks travel to the executors by value, so a cluster needs no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
