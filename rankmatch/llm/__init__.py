"""Operators for preparing training text, and the queries that apply them.

The code that runs in tasks travels with them by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
