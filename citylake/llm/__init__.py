"""Operators for preparing training data: deduplication, filtering, mixing, sharding and vector search.

Functions that run inside Python workers are pickled by value, so a cluster needs no copy of this package on its
executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
