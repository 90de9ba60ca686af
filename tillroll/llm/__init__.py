"""Operators of a training-data pipeline; nothing else in the library imports them.

Functions that run on executors travel by value, so executors do not need this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
