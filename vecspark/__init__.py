"""vecspark: vector, text, hybrid, JSON-table and keyed-table analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with their job, so that executors need
# no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
