"""Operators of a training-data pipeline over document, embedding and conversation tables.

Nothing else in the package imports this one. Task code is sent to the executors by value, so
they need pyspark, numpy and pyarrow but no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
