"""Operators for preparing training text. Nothing outside this package imports it.

Functions of this package travel to executors by value, so a cluster needs no copy of it there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
