"""Operators for training-data pipelines: deduplication, scoring, mixing, packing, sharding, fingerprints.

Functions of this subpackage that run in Python workers are pickled by value, so that executors need no
copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
