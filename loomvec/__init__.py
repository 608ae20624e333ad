"""Text records to embedding tables on Spark, and the care of those tables."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors inside the job itself, so the
# package need not be installed or shipped there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
