"""Operators for training-data pipelines.

Functions that run inside Spark tasks travel to the executors by value, so executors need
the public libraries they import but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
