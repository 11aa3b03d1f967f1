"""Training-data operators; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Task functions travel with their module's code, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
