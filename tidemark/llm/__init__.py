"""Corpus-preparation operators for training data: ten operators and the queries that register them.

Python code that runs inside tasks is shipped by value, so executors need no copy of this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
