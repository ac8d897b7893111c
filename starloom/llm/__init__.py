"""Text operators for training-data pipelines; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the code they use, so executors need
# no copy of it on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
