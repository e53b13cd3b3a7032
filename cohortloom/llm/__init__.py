"""Operators that prepare training text: mixing, fingerprints, deduplication, archives, scoring.

Functions of this subpackage travel to the Python workers by value, so executors need its
dependencies but not the library itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
