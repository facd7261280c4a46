"""Training-data operators: one module per operator, each with its general
interface and the thin ``opN_<name>`` query that applies it to a whole table.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""

import sys

from pyspark import cloudpickle

# Executors then need no copy of this package: functions travel with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
