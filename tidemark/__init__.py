"""Table and stream jobs for click and change feeds, written as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a job runs on a
# cluster whose workers do not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
