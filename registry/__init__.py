"""The registered queries, the tables they derive and the SQL that checks them."""

import sys

from pyspark import cloudpickle

# As for the library: queries pass functions of their own to tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
