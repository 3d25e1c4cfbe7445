"""Operators of a training-data pipeline over ``documents``-like tables.

Each module holds one operator with its own interface; ``queries`` binds
them to the given tables.  Functions that run inside Python workers are
pickled by value, so executors need the listed libraries but not this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
