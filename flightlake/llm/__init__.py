"""Operators for training corpora: fingerprints, filters, deduplication, mixing, tokenising."""

import sys

from pyspark import cloudpickle

# task code travels with the job: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
