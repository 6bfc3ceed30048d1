"""Operators for training-data pipelines; nothing else in the library imports this package.

Functions of this package that run in tasks are sent to the executors by value, so that a cluster needs
the libraries they use there but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
