"""Operators for preparing training text, one module each.

Nothing outside this package imports it. Functions that run inside tasks travel with the job
instead of being imported by the workers, so a cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
