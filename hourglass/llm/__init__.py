"""Training-data pipeline operators; nothing else in the package imports this subpackage.

Functions that run in tasks are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
