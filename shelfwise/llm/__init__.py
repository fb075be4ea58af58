"""Operators for preparing training text; nothing else in the library imports this subpackage."""

from pyspark import cloudpickle

import shelfwise

# Workers need not have this folder on their path.
cloudpickle.register_pickle_by_value(shelfwise)
