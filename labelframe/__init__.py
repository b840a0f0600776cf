"""Preparing, balancing, learning from and evaluating labelled tables with Spark."""

import sys

from pyspark import cloudpickle

# functions sent to the executors carry their code, so only the driver needs this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
