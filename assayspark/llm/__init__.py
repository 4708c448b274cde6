"""Operators for training-data pipelines; their queries register in `queries.py` beside them.

Functions that run inside tasks travel with the job, so executors need numpy and Arrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
