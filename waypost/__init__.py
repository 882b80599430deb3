"""Route-risk analytics expressed as lazy Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Task functions travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
