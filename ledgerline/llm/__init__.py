"""Operators for preparing training text: fingerprints, quality, private data, fixity,
duplicate passages, contamination, language, tokens, near duplicates and link trust.

Functions of this package that run inside tasks travel to the executors by value, so a
cluster needs no copy of the package on its machines.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
