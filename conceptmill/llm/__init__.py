"""Operators of a training-data pipeline, their queries and their checks."""

import sys

from pyspark import cloudpickle

# Task functions of this package travel with the plan, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
