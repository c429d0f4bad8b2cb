"""Entity performance analytics as Spark DataFrame operators."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# task functions travel with their code, so workers need not have the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
