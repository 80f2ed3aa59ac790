"""Operators for preparing large text corpora, on top of Spark.

Nothing else in the library imports this subpackage. Its functions travel to the executors by
value, so the executors need the third-party libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
