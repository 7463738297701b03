"""Operators of a training-data pipeline; nothing else in the package imports them.

Functions that run in Python workers are shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
