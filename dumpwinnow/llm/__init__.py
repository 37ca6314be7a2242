"""Operations of a training-data pipeline over document tables.

Nothing else in the library imports this package.  Its task-side functions are shipped by
value, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
