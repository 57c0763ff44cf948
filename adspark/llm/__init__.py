"""Operators for preparing training data (texts, urls, vectors) at corpus scale.

Nothing else in the library imports this subpackage. Its functions travel with the jobs that use
them (pickled by value), so executors need numpy and pyarrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
