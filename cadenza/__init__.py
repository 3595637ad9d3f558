"""Cadenza: speech quality analytics and corpus preparation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so no executor needs this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
