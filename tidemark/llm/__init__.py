"""Operators for preparing language-model training data. Nothing else in the library imports this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions that run inside Python workers travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
