"""Operators for large-scale training-data pipelines.

Each module holds one operator with its own general interface;
``queries.py`` derives the registered queries from them. Task functions are
shipped to the executors by value, so a cluster needs no installed copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
