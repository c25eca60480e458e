"""Spark-first analytics over curated document collections."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# functions that run on executors travel by value: workers need no copy of the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
