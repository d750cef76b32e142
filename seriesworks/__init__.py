"""Panel time-series analytics on Spark DataFrames.

A *panel* is a DataFrame with one row per (series keys, date).  Every operator
takes a DataFrame plus column names and returns a DataFrame.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no
# copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
