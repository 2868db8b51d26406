"""Signal quality control and cohort analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# task-side helpers travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
