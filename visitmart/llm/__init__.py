"""Operators for large-scale training data.

Functions of this subpackage travel to the executors by value, so that these need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
