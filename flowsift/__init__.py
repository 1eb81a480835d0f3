"""Flow and payload security analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers need not have this package installed: ship its functions with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
