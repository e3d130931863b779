"""Operators for preparing training text: ten methods on tables of documents, pages and vectors.

Nothing else in the library imports this subpackage. Every operator takes and returns DataFrames.
"""

import sys

from pyspark import cloudpickle

# Tasks get these modules' functions by value, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
