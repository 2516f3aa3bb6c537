"""Operators for training-data pipelines; nothing else in the library imports this subpackage.

Its functions run in Spark's Python workers. They are pickled by value, so that
workers need not be able to import the package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
