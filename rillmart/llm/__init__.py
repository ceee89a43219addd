"""Operators for preparing language-model training data.

Nothing outside this package imports it.  Its code travels with the tasks that use it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
