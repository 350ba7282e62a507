"""Operators of a training-data pipeline over documents, pages, conversations and vectors."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Executors get the Python functions of this subpackage with the job; it need not be installed on them.
register_pickle_by_value(sys.modules[__name__])
