"""Estimators, validation, search and the model registry on MLlib."""

import sys

from pyspark import cloudpickle

# Scoring functions travel with the job, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
