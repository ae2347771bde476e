"""Operators of a training-data pipeline; nothing else in the library imports them.

Functions of this package that run in Spark's Python workers travel there by value, so
the package need not be installed on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
