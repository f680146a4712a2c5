"""Hierarchical text corpora in PySpark.

Functions of this package that run inside tasks are pickled by value, so the
executors need no copy of the package (only numpy, pandas and pyarrow).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
