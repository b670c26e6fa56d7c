"""Operators for preparing training data at scale; nothing else in the package imports them.

The functions that run inside tasks travel to the executors by value, so a cluster needs this
package on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
