"""Operators for training-data pipelines; nothing else in the library imports this package.

Task functions travel with the job: executors need numpy, pandas and pyarrow, but no
installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
