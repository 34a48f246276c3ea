"""Operators of a large-scale training-data pipeline.

Thirteen operators over documents, pages and embeddings, each in a module of its
own, their registered queries in ``queries`` and their SQL in ``oracles``.
Nothing else in the library imports this subpackage.

Functions that run inside Spark tasks are pickled by value, so executors need
no copy of this package (only numpy, pandas, pyarrow and, for BPE, ``regex``).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
