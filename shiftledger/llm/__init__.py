"""Operators for training-data pipelines, each with its registered query.

Functions that run on executors are pickled by value, so executors need Spark,
numpy and Arrow, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
