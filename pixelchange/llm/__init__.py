"""Operators for preparing large text corpora.

Nothing else in the library imports this package; it uses only general
helpers of the library (the shared scratch folder).  The functions that
run inside tasks are shipped by value, so executors need numpy, pyarrow
and (where named) a tokenizer library, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
