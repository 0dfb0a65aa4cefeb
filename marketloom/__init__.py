"""Marketloom: listing-marketplace analytics and data preparation on PySpark.

Functions that run in Python workers are pickled by value, so executors need
pyspark, numpy, pandas and pyarrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
