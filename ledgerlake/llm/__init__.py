"""Training-data operators: quality rules, deduplication, mixing, token counts, chat formatting, licence scans,
packing and URL filters.

Nothing else in the library imports this subpackage.  Functions that run in Python workers are pickled by value, so
executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
