"""Operators of a training-data pipeline over text tables.

Task functions of this package travel to the executors with the job, so a
cluster needs the public libraries only and no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
