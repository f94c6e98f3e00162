"""Operators of a training-data pipeline.  Nothing else in the library imports this package.

The functions that run in Spark's Python workers are sent by value, so executors need numpy,
pyarrow and pyahocorasick but no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
