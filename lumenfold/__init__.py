"""lumenfold: light-sheet microscopy volumes and their tables as Spark relations."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
