"""rowhaul: move tables between queries, document collections and files as Spark jobs."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: functions travel with the tasks that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
