"""Operators for training-data pipelines: text in, decisions, scores, digests or tokens out.

Nothing else in the library imports this package. Its functions travel to the executors by value, so that the workers
need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
