"""Operators a training-data pipeline needs, one module each; queries and SQL are in `queries`."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with their code, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
