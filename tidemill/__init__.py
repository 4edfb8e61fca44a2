"""Stream and table analytics on PySpark DataFrames.

Operators take and return DataFrames.  They are written so that no step needs
all rows of one key, one window or one source in a single task.
"""

import sys

from pyspark import cloudpickle

# Some of Spark's Python workers (stream sources, state pre-initialisation) do not
# see files shipped to executors, so code of this package travels with its objects.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
