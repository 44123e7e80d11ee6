"""Operators of a large-scale training-data pipeline.

Each module holds one operator with a general interface; ``queries`` applies them to the
tables of a data folder and derives the digest columns of the registered queries.

Functions that run inside tasks are shipped with the job (pickled by value), so
executors need the installed libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
