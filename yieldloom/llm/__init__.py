"""Operators for training-data pipelines. Nothing outside this subpackage and corpus_pipeline.py imports it.

Functions that run inside tasks are pickled by value, so executors need none of this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
