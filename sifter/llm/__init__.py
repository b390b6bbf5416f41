"""Operators of a training-data pipeline; nothing else in the library imports this package.

Task functions travel to the executors by value, so a cluster needs no copy of
this package on its workers' import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
