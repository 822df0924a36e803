"""Training-data operators (language ID, dedup, packing, filters, ...).

Nothing else in the library imports this subpackage. Functions that run inside Python workers are pickled by
value, so a cluster needs no copy of the package on its executors.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
