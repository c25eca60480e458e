"""Corpus operators for training data. Nothing else in the library imports this package.

Functions of this package that run on executors are pickled by value, so that workers need no copy of the package on
their path.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
