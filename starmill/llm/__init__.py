"""Operators for training-data corpora. Nothing else in the library imports this package.

Functions of this package that run inside tasks travel to the executors by value,
and so do objects sent with ``rows.send``: a cluster needs the listed third-party libraries there but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
