"""rapproche: linkage of large French address lists as Spark DataFrame transforms."""

import sys

from pyspark import cloudpickle

# Arrow functions defined in this package travel inside the job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
