"""millrace: prepare, profile, split, balance, train on and evaluate labelled tables with Spark.

Every operator takes and returns DataFrames. Rows stay on the executors; only results of
bounded size (fitted statistics, weights, cut points, confusion counts) reach the driver.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
