"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Functions that run inside
Spark's Python workers are pickled by value, so executors need numpy, pyarrow,
xxhash and regex but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
