"""Curation, splitting, preprocessing and evaluation of labelled image corpora on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with the job, so that executors
# need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
