"""folioweave: document-graph analytics and corpus data processing on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to executors travel by value, so that no executor needs this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
