"""skillgauge: measure which skills job postings ask for, as Spark jobs.

Every operator is a function from DataFrames to a DataFrame. Nothing runs until
the caller writes or shows the result, except where a docstring says so.
"""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
