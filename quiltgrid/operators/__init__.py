"""Operators over DataFrames, one module per family."""

import sys

from pyspark import cloudpickle

# Executors then need no copy of this package: functions travel with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
