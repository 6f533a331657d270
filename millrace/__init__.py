"""Millrace: dataset curation, auditing and selective-prediction analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their code, so a cluster needs no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
