"""Operators a training-data pipeline needs, over the tables `documents`, `pages` and `labels`.

Nothing else in the library imports this subpackage. Functions defined in it travel to
the Python workers by value, so executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
