"""Training-data operators: cleaning, deduplicating, scoring, mixing and sharding text corpora.

Self-contained: nothing else in the library imports this subpackage. Functions that run in
Python workers are shipped by value, so executors need not have the library installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
