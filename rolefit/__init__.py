"""rolefit: match job postings to candidate profiles with Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions that run inside tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
