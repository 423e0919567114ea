"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# What runs in tasks travels with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
