"""Operators for preparing language-model training data.

Each module holds one operator with its general interface; ``queries``
derives the registered driver queries from them.  Functions that run inside
Python tasks travel by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
