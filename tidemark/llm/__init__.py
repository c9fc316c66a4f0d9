"""Operators of a training-data pipeline. Nothing else in the library imports
this package.

Functions that run in Python workers are pickled by value, so executors need
the usual libraries (numpy, pandas, pyarrow) but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
