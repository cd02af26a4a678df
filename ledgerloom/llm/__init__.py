"""Operators that prepare text corpora for language-model training.

Functions that run in Python workers travel with the query, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
