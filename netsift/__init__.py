"""Domain intelligence and corpus preparation as Spark jobs.

Functions of this package that run in Python workers travel with their jobs, so that executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
