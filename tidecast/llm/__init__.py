"""Operators for training-data pipelines. Nothing else in the package imports this subpackage."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
