"""Operators for preparing training text at scale."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: what runs there travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
