"""beadloom: a PySpark-native engine for spatial-barcode analytics."""

import sys

from pyspark import cloudpickle

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
__version__ = "0.1.0"

# functions travel to the workers as they are, so that executors need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
