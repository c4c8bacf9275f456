"""Operators for preparing training text: one module per operator, queries in ``queries``.

Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# What runs in tasks travels to the workers with the job, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
