"""headroom: capacity analytics on time-series panels, written as Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# The few Python kernels travel with their tasks, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
