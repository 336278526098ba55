"""Operators for preparing training text at scale, and their registered queries."""

import sys

from pyspark import cloudpickle

# The functions that run inside tasks travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
