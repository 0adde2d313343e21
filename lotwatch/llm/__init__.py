"""Training-data operators: classify, search, deduplicate, count and mix documents."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are shipped whole: executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
