"""A PySpark-native engine for property-ownership data: snapshot ingestion, entity
resolution, ownership timelines and intervals, and portfolio analytics."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel by value: executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
