"""Spark operators for positional text, field extraction and resumable routing."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code with them, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
