"""Behaviour and transaction-stream analytics as plain DataFrame functions."""

import sys

from pyspark import cloudpickle

# Task functions travel with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
