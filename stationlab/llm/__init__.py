"""Operators that prepare text corpora for training.

What runs in tasks is sent along by value, so executors need numpy, pandas and pyarrow, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
