"""The registered queries and, next to each, the same question in plain SQL."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
