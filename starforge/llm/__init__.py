"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Functions shipped to executors travel by value, so a cluster needs the public
libraries (numpy, pyarrow, ...) on its workers but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
