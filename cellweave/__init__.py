"""Paired RNA + chromatin-accessibility single-cell analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions used inside tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
