"""fairlead: a PySpark-native engine for vessel position analytics."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run on executors travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
