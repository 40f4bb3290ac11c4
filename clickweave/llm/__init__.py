"""Operators of a training-data pipeline (see README, "Training-data operators").

Functions that run in Python workers travel by value, so executors need no
copy of this package and no working directory of the driver's.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
