"""Operators for preparing large text corpora; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Executors get the code with the task, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
