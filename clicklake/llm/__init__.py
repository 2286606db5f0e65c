"""Operators for preparing training text. Nothing else in the library imports this package.

Task functions are sent to executors by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
