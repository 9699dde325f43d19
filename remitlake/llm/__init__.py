"""Operations of a training-data pipeline over documents."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
