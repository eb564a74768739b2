"""Operators for preparing training text, and their queries.

Nothing else in the library imports this package.  Functions that run in tasks travel with
their plan, so executors need the public libraries only and not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
