"""Operators for training data: filtering, deduplication, scoring, mixing, sharding and encoding of documents and pages."""

import sys

from pyspark import cloudpickle

# The code travels with a job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
