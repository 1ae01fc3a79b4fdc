"""Page-to-table extraction on Spark: stored web pages in, clean directory records out."""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel with the job, so executors need no copy of this
# package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
