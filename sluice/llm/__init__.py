"""Operators for preparing training text: dedup, filters, sampling, packing, search.

Functions that run in Python tasks travel with their code, so executors need the
libraries they use but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
