"""Live statistics and running counts over the ad log."""

import sys

from pyspark import cloudpickle

# The stateful processors travel to the executors by value: they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
