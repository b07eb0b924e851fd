"""Operators for preparing large text corpora.

Nothing else in the package imports this subpackage.  Functions that run in
tasks are pickled by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
