"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

Functions that run in Python workers are shipped with the job, so executors need no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
