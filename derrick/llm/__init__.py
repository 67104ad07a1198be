"""Operators of a training-data pipeline, on documents, pages and labels.

Functions of this package travel to Python workers by value, so executors need no
copy of the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
