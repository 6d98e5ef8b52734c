"""Folioloom: building, curating and querying corpora of hierarchical documents on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
