"""Operators of a training-data pipeline, one module each, and their registered queries (``queries.py``).

Nothing else in the library imports this subpackage.  Functions that run in Python tasks are pickled by
value, so executors need no copy of the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
