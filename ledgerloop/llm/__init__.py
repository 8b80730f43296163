"""Operators of a training-data pipeline; nothing else in the library imports this subpackage.

Functions that run in Python workers are pickled with their code, so that executors need no
copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
