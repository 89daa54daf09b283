"""Business analytics on Spark tables of any size."""

import sys

from pyspark import cloudpickle

# The few functions that run on executors travel with their code, so no executor needs the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
