"""Operators for preparing training text, their queries and checks.

Nothing outside this folder, ``corpus_pipeline.py`` and the entry's guard imports it.
Task code travels by value, so executors need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
