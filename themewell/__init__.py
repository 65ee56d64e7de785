"""Find categories in large sets of short texts with Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions run inside tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
