"""Operators of a training-data pipeline over documents, pages and conversations."""

import sys

from pyspark import cloudpickle

# Functions go to the executors with their code, so that a session without this package on its workers' path runs them too.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
