"""Operators for preparing training data, one module each; ``queries`` registers them.

Functions that run in Python workers travel by value, so that executors need
this package on no path of theirs.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
