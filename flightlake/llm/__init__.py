"""Operators for large-scale training data, each over a plain ``documents``-like DataFrame.

Task functions of this subpackage travel by value, so executors need numpy,
pyarrow and the named libraries but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
