"""Operators of a training-data pipeline over whole text corpora.

Nothing outside this subpackage imports it; ``catalog`` lists its queries.
Functions that run in tasks are shipped by value, so executors need no
installation of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
