"""Training-data operators. Nothing else in the library imports this package.

Functions that run in tasks travel to the executors by value, so a cluster needs no copy of
the package on its Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
