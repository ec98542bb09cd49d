"""Training-data operators: one module per operator, ``registry`` for the queries.

Functions of this package travel to the executors by value, so a session that
was started without this package on its workers' path can run them.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
