"""millrace: a PySpark-native analytics engine.

Everything is a DataFrame in and a DataFrame out; Spark plans, shuffles and
runs the work.
"""

import sys

from pyspark import cloudpickle

# Small functions that run in Python workers travel with the query, so that
# executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
