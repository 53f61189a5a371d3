"""Operators for preparing training corpora. Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage go to the executors as they are, so those need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
