"""Operators for preparing large text corpora as training data.

Ten operators and their checked queries (``queries.py``); nothing else in
the library imports this subpackage.  Every operator takes and returns
DataFrames.  Functions that run in Spark's Python workers are shipped by
value, so executors need numpy, pandas and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
