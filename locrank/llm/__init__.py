"""Operators of a training-data pipeline; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Python code of these modules travels with the tasks, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
