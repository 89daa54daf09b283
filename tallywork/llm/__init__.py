"""Operators for large text corpora: deduplication, filtering, tokenizing, packing and formatting.

Each module holds one operator with its general interface; ``queries`` applies them to the tables.
Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their code, so no executor needs the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
