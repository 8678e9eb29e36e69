"""Operators for preparing training data. Nothing outside this package imports it."""

import os
import sys

from pyspark import cloudpickle

_root = os.path.realpath(os.path.join(os.path.dirname(__file__), "..", ".."))
_seen_by_workers = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
if _root not in map(os.path.realpath, _seen_by_workers):
    # Tasks get the code with the job where their Python would not find it.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
