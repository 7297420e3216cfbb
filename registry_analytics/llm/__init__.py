"""Operators of a training-data pipeline; nothing outside this package imports it.

Functions of this package that run on executors are shipped with the job (pickled by value), so the
package need not be installed on the workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
