"""Evidence analytics on Spark: DataFrame operators for long, paginated documents."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors whole, so that these need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
