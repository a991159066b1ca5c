"""Operators for preparing language-model training data, one module each.

Nothing else in the library imports this subpackage. ``queries`` registers one query per operator. Functions that run in
tasks are sent by value, so executors need numpy, pyarrow, xxhash and zstandard, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
