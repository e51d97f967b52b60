"""Operators of a training-data pipeline over a table of documents.

Nothing outside this subpackage imports it; `queries` holds what
`__spark_entry__` adds when the subpackage is there.
"""

import sys

from pyspark import cloudpickle

# Functions shipped to executors travel by value, so that a worker needs
# no particular working directory or PYTHONPATH.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
