"""Operators for large training-data pipelines; nothing else in the library
imports this subpackage.

Code that runs in Python workers is pickled by value, so executors need no copy
of the package and no shared folder for it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
