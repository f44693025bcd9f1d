"""loamgrid: a PySpark-native analytics engine for property, permit, company and document data.

Everything is a function from DataFrames to DataFrames; nothing here starts a session on import.
Functions that run on executors are shipped by value, so a cluster needs no copy of this package.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__version__ = "0.1.0"
