"""Transaction monitoring and alert analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel whole with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.2.0"
