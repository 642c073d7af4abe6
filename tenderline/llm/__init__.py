"""Operators that prepare documents for training language models.

Functions that run in tasks travel by value, so executors need not have this package installed."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
