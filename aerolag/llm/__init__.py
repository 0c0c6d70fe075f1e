"""Operators of a training-data pipeline. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
