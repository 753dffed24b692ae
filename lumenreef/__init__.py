"""lumenreef: catalog quality, experiment analytics and corpus preparation on Spark.

Functions that run inside Python workers are shipped by value, so a cluster
needs no installed copy of this package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
