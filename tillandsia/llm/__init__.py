"""Operators for preparing training data at scale.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` derives the registered
``opN_<name>`` queries from them.

Functions that run in Python workers are shipped by value, so executors need
no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
