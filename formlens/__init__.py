"""formlens: survey form intake, cleaning and reporting as Spark jobs.

The few Python functions that run inside tasks (header normalisation,
fuzzy header matching, CSV header-line parsing) are pickled by value, so
executors need no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
