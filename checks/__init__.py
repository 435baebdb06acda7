"""Every operator run over the given tables, next to the same question in SQL."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
