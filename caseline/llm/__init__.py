"""Operators that prepare training corpora, each a Spark job over documents, pages or conversations."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors with the job, so that the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
